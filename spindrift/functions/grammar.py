"""Wikitext markup to plain text.

Alternatives are tried in a fixed order and fall back to a literal character, as in a parsing expression grammar. Three
things keep the time in proportion to the text: what a construct yields at a place is remembered, a scan that ran to
the end of the text without its closer marks every place it passed, so that no later scan of the kind passes there, and
a search that found nothing isn't repeated behind its start.

Constructs that hold others are generators that yield those they wait for, and run() keeps the stack; so nesting may be
of any depth.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Callable, Generator, Mapping
from types import GeneratorType

from spindrift.functions.templates import COUNTRIES, expand
from spindrift.functions.text import lines, trim

# Second-level sections that are left out.
DROPPED_SECTIONS = [
    "see also", "notes", "references", "external links", "footnotes", "further reading", "gallery", "explanatory notes", "citations", "general bibliography",
    "notes and references", "sources", "further reading & references",
]

# Links that are left out begin so.
DROPPED_LINKS = ("file:", "image:", "category:")

# Templates that open a table.
TABLE_TEMPLATES = [
    "Awards table", "Certification Table Top", "LegSeats", "NRHP header", "col-begin", "HS listed building header", "election table", "Bs out2 header", "Bs in2 header", "OneLegStart",
    "NRHP former header", "TwoLegStart", "AFL player statistics start", "Start NFL SBS", "Office-table", "MMA record start", "International goals header", "Cabinet table start",
    "Jockey colours header", "PresHead", "Fb cl3 header navbar", "Graphic novel list/header", "fb disc header", "Ordinal US Congress change", "Fb_kit header",
    "Canadian politics/candlist header", "College ice hockey team roster", "Election Summary Begin", "NZ election box begin", "TLS-H2", "col-start", "Efs start", "EH listed building header",
    "CANelec/top", "Vb res start",
]

# Elements whose content stays, elements that go with their content, tags that go alone.
KEPT_ELEMENTS = ["small", "big", "sub", "sup", "span", "blockquote", "abbr", "poem", "syntaxhighlight"]
DROPPED_ELEMENTS = ["imagemap", "gallery", "math", "score", "code", "references"]
BARE_TAGS = ["div", "br", "onlyinclude", "section"]

_FLAGS = re.DOTALL | re.IGNORECASE
_BARE = re.compile(rf"</?[ \t]*(?:{'|'.join(BARE_TAGS)})")
_VOID = re.compile(r"<(ref|nowiki)")
_ELEMENT = re.compile(rf"<({'|'.join(KEPT_ELEMENTS + DROPPED_ELEMENTS)})")
_REFBEGIN, _REFEND = re.compile(r"\{\{refbegin", re.IGNORECASE), re.compile(r"\{\{refend[^{}]*\}\}|(?=\n==)", _FLAGS)
_BRACKETED = re.compile(r"\{\{[^{}]+\}\}[^{}]*\{\{(?:s-)?end[^{}]*\}\}", _FLAGS)
_SQUAD, _SQUAD_END = re.compile(r"\{\{fs start[^{}]*\}\}", _FLAGS), re.compile(r"\{\{fs end[^{}]*\}\}", _FLAGS)
_OPENING = re.compile("|".join([rf"\{{\{{(?:{'|'.join(map(re.escape, TABLE_TEMPLATES))})", r"\{\{(?:[^\W_]|\s)*?(?:start|header|table)[ \t]*(?:\||\}\})"]), _FLAGS)
_TABLE = re.compile("|".join(x.pattern for x in (_OPENING, _REFBEGIN, _SQUAD, _BRACKETED)), _FLAGS)
_BULLET = re.compile(r"\n[*:;#]+")
_HEADER = re.compile(r"\n==(?=[^=])", re.DOTALL)
#: What is no markup at the top level: neither a doubled bracket, brace or quote, nor a line that begins as lists, headings and tables do.
_PLAIN = re.compile(r"(?:[^\n{\[<']++|\n(?![: ]*+[<{]|[:=*;#])|\[(?!\[)|\{(?!\{)|'(?!'))++")
#: Links, templates and items that hold no markup: one match reads them.
_PLAIN_LINK, _PLAIN_TEMPLATE, _PLAIN_ITEM = re.compile(r"\[\[([^\[\]\n{<']*+)\]\]"), re.compile(r"\{\{([^{}\n\[<']*+)\}\}"), re.compile(r"\n[*:;#]++([^{<\n]*+)(?=\n)")
_IN_TEMPLATE, _IN_LINK, _IN_ELEMENT, _IN_LIST, _IN_TABLE, _IN_SECTION = (re.compile(x) for x in (r"[^{}<]+", r"[^\[\]]+", r"[^<]+", r"[^{<\n]+", r"[^\n{<]+", r"[^\n<]+"))

Found = tuple[int, str] | None
Reading = Generator["Reading | Found", Found, Found]


def run(first: Reading) -> Found:
    """The value of a generator that yields other generators for their values, or values as they are; the stack is a list."""
    stack, value = [first], None
    while stack:
        try:
            waits_for = stack[-1].send(value)
        except StopIteration as end:
            stack.pop()
            value = end.value
        else:
            value = None
            if isinstance(waits_for, GeneratorType):
                stack.append(waits_for)
            else:
                value = waits_for
    return value


class _Reader:
    """One text being read. templates: whether a template may stand at the top level, which it may not in a template's own body.

    A reader of a construct gives what it found at a place, or None, or a generator whose value that is.
    """

    def __init__(self, s: str, countries: Mapping[str, str], templates: bool = True):
        self.s, self.n, self.countries, self.templates = s, len(s), countries, templates
        self.known: dict[tuple[str, int], Found] = {}
        self.dead: dict[str, set[int]] = {}
        self.absent: dict[str, int] = {}
        self.ahead: dict[str, tuple[int, int]] = {}
        self.matched: dict[str, tuple[int, re.Match]] = {}
        self.closing_from: dict[str, tuple[list[int], list[int]]] = {}

    def find(self, what: str, at: int) -> int:
        """str.find; the last place found is remembered with where the search began, and so is that there was none."""
        if at >= self.absent.get(what, self.n):
            return -1
        since, to = self.ahead.get(what, (0, -1))
        if since <= at <= to:
            return to
        to = self.s.find(what, at)
        if to < 0:
            self.absent[what] = at
        else:
            self.ahead[what] = (at, to)
        return to

    def search(self, what: re.Pattern, at: int) -> re.Match | None:
        if at >= self.absent.get(what.pattern, self.n):
            return None
        since, m = self.matched.get(what.pattern, (0, None))
        if m and since <= at <= m.start():
            return m
        m = what.search(self.s, at)
        if m:
            self.matched[what.pattern] = (at, m)
        else:
            self.absent[what.pattern] = at
        return m

    def never_closes(self, pair: str, at: int) -> bool:
        """Whether the opener at a place has no closer: none is left behind it, or later openers take them all.

        For a pair of brackets between which nothing else is read. One pass from the end counts the closers that are left
        for each run of opening characters; in a run the last openers get them, also those at odd places of a run, where
        one fewer stands behind. So it is known for each run from which place on openers close.
        """
        opener, closer = pair[:2], pair[2:]
        if self.find(closer, at + 2) < 0:
            return True
        if pair not in self.closing_from:
            left, found = 0, []
            for m in reversed(list(_PAIRS[pair].finditer(self.s))):
                if m[0][0] == closer[0]:
                    left += len(m[0]) // 2
                else:
                    found.append((m.start(), m.end() - 2 * left - 1))
                    left -= min(left, len(m[0]) // 2)
            found.reverse()
            self.closing_from[pair] = [f for f, _ in found], [f for _, f in found]
        starts, first = self.closing_from[pair]
        return at < first[bisect_right(starts, at) - 1]

    def once(self, kind: str, at: int, read: Callable[[int], Reading]) -> Reading | Found:
        key = (kind, at)
        return self.known[key] if key in self.known else self._once(key, read)

    def _once(self, key: tuple[str, int], read: Callable[[int], Reading]) -> Reading:
        found = self.known[key] = yield read(key[1])
        return found

    def until(self, kind: str, at: int, closer: Callable[[int], int | None], plain: re.Pattern, *inner: Callable[[int], Reading | Found]) -> Reading:
        """What is read from at up to a closer, each place by the first of inner that reads there, else as text."""
        out, passed, dead = [], [], self.dead.setdefault(kind, set())
        while True:
            if (end := closer(at)) is not None:
                return end, "".join(out)
            if at >= self.n or at in dead:
                dead.update(passed)
                return None
            passed.append(at)
            found = None
            for read in inner:
                found = read(at)
                if isinstance(found, GeneratorType):
                    found = yield found
                if found:
                    break
            if not found:
                m = plain.match(self.s, at)
                found = (m.end(), m[0]) if m else (at + 1, self.s[at])
            at = found[0]
            out.append(found[1])

    def again(self, s: str, templates: bool = True) -> Reading | Found:
        m = _PLAIN.match(s)
        if (m.end() if m else 0) == len(s):
            return len(s), s
        return _Reader(s, self.countries, templates).text()

    def text(self) -> Reading:
        """The whole text with its length; never fails, as any character may stand for itself."""
        out, at = [], 0
        by_first = {
            "\n": (self.table, self.section, self.items),
            "{": (self.table, self.template) if self.templates else (self.table,),
            "[": (self.link,),
            "'": (self.quote,),
            "<": (self.void, self.comment, self.element, self.bare),
        }
        while at < self.n:
            if m := _PLAIN.match(self.s, at):
                out.append(m[0])
                at = m.end()
                continue
            found = None
            for read in by_first[self.s[at]]:
                found = read(at)
                if isinstance(found, GeneratorType):
                    found = yield found
                if found:
                    break
            at, piece = found or (at + 1, self.s[at])
            out.append(piece)
        return self.n, "".join(out)

    def tag_end(self, head: re.Pattern, at: int) -> tuple[int, re.Match] | None:
        """Where the tag that begins with head ends, and the head."""
        m = head.match(self.s, at)
        to = self.find(">", m.end()) if m else -1
        return (to + 1, m) if to >= 0 else None

    def closing(self, name: str) -> Callable[[int], int | None]:
        head = f"</{name}"

        def closer(at: int) -> int | None:
            to = self.find(">", at + len(head)) if self.s.startswith(head, at) else -1
            return to + 1 if to >= 0 else None

        return closer

    def literal(self, closer: str) -> Callable[[int], int | None]:
        return lambda at: at + len(closer) if self.s.startswith(closer, at) else None

    def comment(self, at: int) -> Found:
        to = self.find("-->", at + 4) if self.s.startswith("<!--", at) else -1
        return (to + 3, "") if to >= 0 else None

    def bare(self, at: int) -> Found:
        found = self.tag_end(_BARE, at)
        return (found[0], "") if found else None

    def void(self, at: int) -> Found:
        found = self.tag_end(_VOID, at)
        if not found or trim(self.s[found[1].end() : found[0] - 1]).endswith("/"):
            return (found[0], "") if found else None
        end = f"</{found[1][1]}>"
        to = self.find(end, found[0])
        return (to + len(end), "") if to >= 0 else None

    def element(self, at: int) -> Reading | Found:
        return self.once("element", at, self._element) if self.s.startswith("<", at) else None

    def _element(self, at: int) -> Reading:
        head = self.tag_end(_ELEMENT, at)
        if not head:
            return None
        name = head[1][1]
        found = yield self.until(name, head[0], self.closing(name), _IN_ELEMENT, self.element)
        if not found or name not in KEPT_ELEMENTS:
            return found and (found[0], "")
        _, inner = yield self.again("\n" + found[1])
        return found[0], trim(inner)

    def template(self, at: int) -> Reading | Found:
        if not self.s.startswith("{{", at):
            return None
        if m := _PLAIN_TEMPLATE.match(self.s, at):
            return m.end(), expand(m[1], self.countries) or ""
        if self.find("}}", at + 2) < 0:
            return None
        if not self.search(_ELEMENT, at) and self.never_closes("{{}}", at):  # an element may hide braces
            return None
        return self.once("template", at, self._template)

    def _template(self, at: int) -> Reading:
        found = yield self.until("template", at + 2, self.literal("}}"), _IN_TEMPLATE, self.element, self.template)
        if not found:
            return None
        _, body = yield self.again(found[1], templates=False)
        return found[0], expand(body, self.countries) or ""

    def link(self, at: int) -> Reading | Found:
        if not self.s.startswith("[[", at):
            return None
        if m := _PLAIN_LINK.match(self.s, at):
            return m.end(), self.shown(m[1])
        return None if self.never_closes("[[]]", at) else self.once("link", at, self._link)

    def _link(self, at: int) -> Reading:
        found = yield self.until("link", at + 2, self.literal("]]"), _IN_LINK, self.link)
        if not found:
            return None
        _, s = yield self.again(found[1])
        return found[0], self.shown(s)

    def shown(self, link: str) -> str:
        if link[:_LONGEST].lower().startswith(DROPPED_LINKS):
            return ""
        head, bar, tail = link.partition("|")
        return tail if bar else head

    def items(self, at: int) -> Reading | Found:
        if m := _PLAIN_ITEM.match(self.s, at):
            inner = self.again("\n" + m[1])
            return self._item(m.end(), inner) if isinstance(inner, GeneratorType) else (m.end(), inner[1])
        m = _BULLET.match(self.s, at)
        return self._items(m.end()) if m else None

    def _item(self, end: int, content: Reading) -> Reading:
        _, inner = yield content
        return end, inner

    def _items(self, at: int) -> Reading:
        found = yield self.until("items", at, lambda at: at if self.s.startswith("\n", at) else None, _IN_LIST, self.element, self.template)
        if not found:
            return None
        _, inner = yield self.again("\n" + found[1])
        return found[0], inner

    def heading(self, at: int) -> tuple[int, str] | None:
        """A second-level heading: where it ends, and its name in lower case."""
        if not _HEADER.match(self.s, at):
            return None
        to = self.find("==", at + 3)
        if to < 0 or to + 2 >= self.n or self.s[to + 2] == "=":
            return None
        return to + 2, trim(self.s[at + 3 : to]).lower()

    def section(self, at: int) -> Found:
        found = self.heading(at)
        if not found or found[1] not in DROPPED_SECTIONS:
            return None
        at = found[0]
        while at < self.n and not self.heading(at):
            m = _IN_SECTION.match(self.s, at)
            passed = self.comment(at)
            at = m.end() if m else passed[0] if passed else at + 1
        return at, ""

    def quote(self, at: int) -> Reading | None:
        return self._quote(at) if self.s.startswith("''", at) else None

    def _quote(self, at: int) -> Reading:
        for width in (5, 3, 2):
            if self.s.startswith("'" * width, at) and (found := (yield self.emphasis(width, at + width))):
                parts, end = [], found
                while isinstance(end, tuple):
                    end, part, rest = end
                    parts.append(part)
                    end = rest or end
                _, inner = yield self.again("".join(parts))
                return end, inner
        return None

    def emphasis(self, width: int, at: int) -> Reading:
        key = (f"emphasis {width}", at)
        if key not in self.known:
            self.known[key] = yield self._emphasis(width, at)
        return self.known[key]

    def _emphasis(self, width: int, at: int) -> Reading:
        """From inside of quotes of a width to their end, on one line: each run of quotes ends it or leads to another
        width. As (end, text, what follows): end counts in the last of this chain only."""
        to = self.find("''", at)
        line = self.s.find("\n", at, to) if to >= 0 else -1
        if to < 0 or line >= 0:
            return None
        for quotes, then in _QUOTES[width]:
            if self.s.startswith("'" * quotes, to):
                rest = (yield self.emphasis(then, to + quotes)) if then else None
                if rest or not then:
                    return to + quotes, self.s[at:to], rest
        return None

    def table(self, at: int) -> Reading | Found:
        if self.s[at] == "{":
            if not _TABLE.match(self.s, at):
                return None
        elif self.s[at] != "\n" or not self.s.startswith(_AFTER_LINE, at + 1):
            return None
        return self.once("table", at, self._table)

    def _table(self, at: int) -> Reading:
        for head, end in ((_REFBEGIN, _REFEND), (_SQUAD, _SQUAD_END)):
            if (m := head.match(self.s, at)) and (m := self.search(end, m.end())):
                return m.end(), ""
            if head is _REFBEGIN and (m := _BRACKETED.match(self.s, at)):
                return m.end(), ""
        start = yield self._table_start(at)
        if start is None:
            return None
        found = yield self.until("table", start, self.table_end, _IN_TABLE, self.table, self.formula)
        return found[0] if found else self.n, ""

    def _table_start(self, at: int) -> Reading:
        if self.s[at] == "{":
            m = _OPENING.match(self.s, at)
            return m.end() if m else None
        at += 1
        while at < self.n:
            if self.s[at] in ": ":
                at += 1
                continue
            found = self.bare(at) or self.comment(at) or self.template(at)
            if isinstance(found, GeneratorType):
                found = yield found
            if not found or found[1]:
                break
            at = found[0]
        if not self.s.startswith("{", at):
            return None
        at = self.comments(at + 1)
        return at + 1 if self.s.startswith("|", at) else None

    def comments(self, at: int, blank: str = "") -> int:
        """Where comments, and the blank characters between them, end."""
        while at < self.n:
            if self.s[at] in blank:
                at += 1
            elif found := self.comment(at):
                at = found[0]
            else:
                break
        return at

    def table_end(self, at: int) -> int | None:
        """Behind the bar and brace that close a table at the start of a line, before another character than a brace; or where a second-level heading begins."""
        if not self.s.startswith("\n", at):
            return None
        to = self.comments(at + 1, " \t\r")
        if self.s.startswith("|", to):
            to = self.comments(to + 1)
            if self.s.startswith("}", to) and to + 1 < self.n and self.s[to + 1] != "}":
                return to + 1
        return at if self.s.startswith("\n==", at) and at + 3 < self.n and self.s[at + 3] != "=" else None

    def formula(self, at: int) -> Reading | None:
        head = self.tag_end(_MATH, at)
        return self._formula(head[0]) if head else None

    def _formula(self, at: int) -> Reading:
        found = yield self.until("formula", at, self.closing("math"), _IN_ELEMENT, self.element)
        return (found[0], "") if found else None


_MATH = re.compile(r"<math")
_PAIRS = {"[[]]": re.compile(r"\[\[+|\]\]+"), "{{}}": re.compile(r"\{\{+|\}\}+")}
#: What a table at the start of a line can begin with: spaces, a tag, a comment, a template or its own brace.
_AFTER_LINE = (":", " ", "<", "{")
_LONGEST = max(map(len, DROPPED_LINKS))

#: For each width the closers in order: how many quotes, and the width that goes on behind them (0: the end).
_QUOTES = {2: ((3, 5), (2, 0)), 3: ((3, 0), (2, 5)), 5: ((5, 0), (3, 2), (2, 3))}

_ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
# Entities that are still replaced in text that was decoded once already.
LEFT_ENTITIES = {"&ndash;": "–", "&nbsp;": "\xa0", "&minus;": "-"}
_SIGNS, _SPACES = re.compile(r"\([^a-zA-Z0-9]*"), re.compile(r"  +")


def _without_parentheses(m: re.Match) -> str:
    """A run without letters and digits, from its first opening parenthesis on, less what stands up to its last closing one."""
    return m[0].rpartition(")")[2]


def parsed(s: str, countries: Mapping[str, str] = COUNTRIES) -> str:
    """The markup resolved, before the clean-up."""
    return run(_Reader(s, countries).text())[1]


def plain_text(wikitext: str | bytes | None, decode_entities: bool = True, countries: Mapping[str, str] = COUNTRIES) -> str | None:
    """The article's text: markup resolved, remnants of tables and empty lines, parentheses without letters or digits, and runs of spaces removed.

    decode_entities: set it for bare wikitext; what an XML reader gave is decoded already. Invalid UTF-8 is replaced. None for None.
    """
    if wikitext is None:
        return None
    s = wikitext.decode("utf-8", "replace") if isinstance(wikitext, bytes) else wikitext
    if decode_entities:
        s = _ENTITY.sub(lambda m: html.unescape(m[0]), s)
    for entity, to in LEFT_ENTITIES.items():
        s = s.replace(entity, to)
    kept = [x for x in lines(parsed("\n" + s, countries)) if (t := trim(x)) and t[0] not in "|!"]
    return _SPACES.sub(" ", _SIGNS.sub(_without_parentheses, trim("\n".join(kept))))

import random
import re
import time

import pytest

from spindrift.functions import grammar
from spindrift.functions.grammar import parsed, plain_text

NL = "\n"

VECTORS = [
    ("'''A''' is [[B|bee]]", "A is bee"),
    ("x<ref name=a/>y<ref>z</ref>", "xy"),
    ("[[File:x.png|thumb|cap]]", ""),
    ("\n== See also ==\n* a\n\n== H ==\nt", "== H ==\nt"),
    ("a <!-- c --> b", "a b"),
    ("H<sub>2</sub>O", "H2O"),
    ("{{foo|bar}}", ""),
    ("x (ɑ) y", "x y"),
    ("'' open", "'' open"),
    ("''a\nb''", "''a\nb''"),
    ("'''''x''' y'' z", "x y z"),
    ("'''''x'' y''' z", "x y z"),
    ("a\n{| class=x\n|-\n| b\n|}\nc", "a\nc"),
    ("a\n{|\n{|\n| in\n|}\n| out\n|}\nc", "a\nc"),
    ("a\n{| open\n| to the end", "a"),
    ("a\n{| open\n== H ==\nx", "a\n== H ==\nx"),
    ("a{{col-begin}}x\n== H ==\nx", "a\n== H ==\nx"),
    ("{{box}} x {{s-end}}y", "y"),
    ("{{fs start}}{{fs player|a}}{{fs end}}y", "y"),
    ("{{refbegin}}* a{{refend}}y", "y"),
    ("* one\n* two\nx", "one\n two\nx"),
    ("* last", "* last"),
    ("[[:Category:x]]", ":Category:x"),
    ("[[A|]]b", "b"),
    ("[http://x y]", "[http://x y]"),
    ("{{nowrap|a {{small|b}}}}", "a b"),
    ("{{small|[[a|b]]}}", "b"),
    ("<div class=a>k</div><br/>l", "kl"),
    ("<references/>x", "x"),
    ("<math>x</math>q <code>y", "q <code>y"),
    ("<nowiki>'''x'''</nowiki>y", "y"),
    ("a&nbsp;b &amp; c &copy; &unknown;", "a\xa0b & c © &unknown;"),
    ("| cell\n! head\n\ntext", "text"),
    ("a\r\nb", "a\nb"),
    ("", ""),
    ("== End ==", "== End =="),
    ("{{a{{b", "{{a{{b"),
    ("[[a [[b]]", "[[a b"),
]


@pytest.mark.parametrize(("wikitext", "plain"), VECTORS)
def test_vectors(wikitext, plain):
    assert plain_text(wikitext) == plain


def test_decoded_text_keeps_entities_but_three():
    assert plain_text("&amp;lt; &ndash; &mdash;", decode_entities=False) == "&amp;lt; – &mdash;"
    assert plain_text("&amp;lt;") == "&lt;"


def test_none_and_bytes():
    assert plain_text(None) is None
    assert plain_text(b"a\xff") == "a�"


@pytest.mark.parametrize("text", ["{{" * 2000, "{{" * 2000 + "}}", "[[" * 2000, "<small>" * 2000, "''" * 3000 + "x", "{{a|" * 1500 + "}}" * 1500, "\n{|" * 1000, "<ref>" * 2000, "\n*{{" * 1000])
def test_time_is_not_exponential(text):
    began = time.perf_counter()
    plain_text(text)
    assert time.perf_counter() - began < 5


def test_plain_prose_is_left_alone():
    rng = random.Random(5)
    for _ in range(200):
        prose = " ".join("".join(rng.choice("abcdeé中") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 40)))
        assert plain_text(prose) == prose


def test_nested_markup_ends_and_leaves_no_braces():
    rng = random.Random(7)

    def made(depth):
        parts = ["word", " ", "1"]
        if depth:
            for wrap in ("[[a|{}]]", "{{{{small|{}}}}}", "<span>{}</span>"):
                if rng.random() < 0.5:
                    parts.append(wrap.format(made(depth - 1)))
            # Quotes, references and comments don't nest in themselves.
            parts += [w.format("word") for w in ("'''{}'''", "<ref>{}</ref>", "<!--{}-->") if rng.random() < 0.5]
        rng.shuffle(parts)
        return "".join(parts)

    for _ in range(100):
        assert not set("{}[]") & set(plain_text("x" + made(3)) or "")


ARTICLE = """{{Short description|A made-up lake}}
{{Infobox body of water
| name = Lake Orrin
| area = {{convert|12|km2|sqmi}}
| pushpin = {{flagIOC|NOR}}
}}
[[File:Orrin.jpg|thumb|left|The lake in [[May]], seen from the {{convert|300|m}} ridge]]
'''Lake Orrin''' ({{lang|no|Orrinvatn}}; ''the clear one'') is a [[lake|mountain lake]] in the north.<ref name="map">{{cite web|title=Map}}</ref> It lies {{convert|300|to|340|m}} high ({{IPAc-en|x}}) and was mapped {{circa|1820|1840}}.<!-- by whom? --> It &ndash; like others &mdash; freezes&nbsp;early.

== Geography ==
The shore is {{frac|3|1|2}} miles long. Streams:
* [[Upper Burn]], '''''fast'''''
* the {{nowrap|{{small|Lower}} Burn}}
** named by {{sortname|Ada|Vik}}
after that.

{| class="wikitable"
|-
! Year !! Level
|-
| 1990 || {{val|4|2}}
|}
=== Islands ===
There are three.<br />None is settled.<gallery>
File:a.png|one
</gallery>
=== Bays ===
== History ==
Founded on {{start date|1871|5|3}}. {{quote|Cold water.|A. Vik|Letters}}
<div style="x">Said <span class="q">the [[Vik family|Viks]]</span> H<sub>2</sub>O.</div>
{{unknown template|a}}
== See also ==
* [[Other lake]]
== References ==
{{reflist}}
== Legacy ==
A ship, the {{SS|Orrin}}.
== External links ==
* [http://example.org site]
[[Category:Lakes]]
"""
PLAIN = """Lake Orrin (Orrinvatn; the clear one) is a mountain lake in the north. It lies 300 to 340 m high and was mapped circa 1820-1840. It – like others — freezes\xa0early.
== Geography ==
The shore is 3 1/2 miles long. Streams:
 Upper Burn, fast
 the Lower Burn
 named by Ada Vik
after that.
=== Islands ===
There are three.None is settled.
=== Bays ===
== History ==
Founded on May 3, 1871. "Cold water."-A. Vik, Letters
Said the Viks H2O.
== Legacy ==
A ship, the Orrin."""


def test_a_whole_article():
    assert plain_text(ARTICLE) == PLAIN


OPENERS = ["<!--", "<ref>", "<div ", "{{refbegin ", "{{fs start}}", "[[", "{{", "<small>", "</small ", "''", "\n{|", "\n== a", "\n<!-- ", "<math>", "{{start ", "(", "( "]


@pytest.mark.parametrize("opener", OPENERS)
def test_time_grows_as_the_text(opener):
    """What is never closed takes time in proportion: ten times the text, far less than a hundred times the time."""
    def seconds(n):
        began = time.process_time()
        plain_text(opener * (n // len(opener)))
        return time.process_time() - began

    assert seconds(200_000) < 30 * max(seconds(20_000), 0.05)


@pytest.mark.parametrize("text", ["[[" * 500_000, "{{" * 500_000, "{{refbegin " * 90_000, "[[" * 500_000 + "]]", "{{" * 500_000 + "}}", "[[{{" * 250_000, "[[a " * 250_000])
def test_a_megabyte_of_openers_takes_seconds(text):
    began = time.process_time()
    plain_text(text)
    assert time.process_time() - began < 15  # 2 to 5 on a machine that does nothing else


RUNS = {
    "[[[[x]]": "[[x",
    "[[[[[x]]": "[[[x",
    "[[a[[[b]]]]": "a[b",
    "[[[[[[a]]]]]": "[[a]",
    "a [[b [[c|d]] e": "a [[b d e",
    "{{{{refend}}]": "{]",
    "{{{{{{lang|a|b}}": "{{{",
    "[[a {{b [[c]] d": "[[a {{b c d",
    "{{a<ref>{{</ref> }} z": "{{a }} z",
    "]][[a]]]]": "]]a]]",
    "[[[": "[[[",
    "{{{{{a}}}": "{{}",
}


@pytest.mark.parametrize("text", RUNS)
def test_which_openers_of_a_run_close(text):
    """The last ones; an opener may overlap the one before it, that doesn't close."""
    assert parsed("\n" + text)[1:] == RUNS[text]


@pytest.mark.parametrize(("opener", "closer"), [("[[", "]]"), ("{{", "}}"), ("<small>", "</small>"), ("{{nowrap|", "}}"), ("\n{|", "\n|}")])
def test_nesting_may_be_of_any_depth(opener, closer):
    depth = 12_000
    inner = "x" if opener in ("[[", "<small>", "{{nowrap|") else ""
    assert plain_text("good [[a|b]] " + opener * depth + "x" + closer * depth + " z") == " ".join(w for w in ("good b", inner, "z") if w)


def test_plain_constructs_are_read_as_others_are(monkeypatch):
    """Links, templates, items and lines that one match reads give what the grammar gives for them place by place."""
    pieces = ["[[", "]]", "[", "]", "{{", "}}", "{", "}", "|", "{|", "\n{|", "|}", "\n", "\n*", "\n==", "==", "''", "'''", "'", "<", "<ref>", "</ref>", "<small>", "</small>", "<!--", "-->", "<br>"]
    pieces += ["a", "bc", "File:x", "(", ")", "\n ", "\n:", "\n : ", "start", "end", "{{refbegin", "{{refend}}", "circa|1900", "lang|fr|x", "See also", "{{small|", "fs start", " "]
    chosen = random.Random(5)
    texts = ["".join(chosen.choice(pieces) for _ in range(chosen.choice([4, 12, 30, 90]))) for _ in range(3000)]
    found = [grammar.plain_text(t) for t in texts]
    monkeypatch.setattr(grammar, "_PLAIN", re.compile(r"[^\n{\[<']+"))
    for name in ("_PLAIN_LINK", "_PLAIN_TEMPLATE", "_PLAIN_ITEM"):
        monkeypatch.setattr(grammar, name, re.compile(r"(?!)"))
    monkeypatch.setattr(grammar, "_AFTER_LINE", "")
    for t, f in zip(texts, found, strict=True):
        assert grammar.plain_text(t) == f, t

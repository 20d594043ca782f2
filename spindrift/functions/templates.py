"""Wikitext templates as plain text.

Most templates are stated by patterns: {a} stands for parameter a, {a|b} for the first of them that is there, and what
is in [ ] is left out if a parameter in it isn't there. A pattern with a missing parameter outside of [ ] has no
value, and then the next of a rule's patterns counts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from functools import cached_property, lru_cache

from spindrift.functions.text import trim, whole

# Month names by number from 1.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]

# Templates that always read the same.
CONSTANTS = {
    "--)": ")",
    "'": "'",
    "' \"": "'\"",
    "\" '": "\"'",
    "'\"": "'\"",
    "spaces": " ",
    "snd": " - ",
    "spnd": " - ",
    "spaced ndash": " - ",
    "ndash": "-",
    "nbsp": " ",
    "'s": "'s",
    "en dash": "–",
    "year": "2024",
    "!": "!",
    "no": "No",
    "yes": "Yes",
    "yes2": "Yes",
    "yes-no": "Yes",
    "won": "Won",
    "nom": "Nominated",
    "n/a": "N/A",
    "r": "",
    "·": "·",
    "gold1": "1",
    "silver2": "2",
    "col": "",
    "for": "",
    "end": "",
    "ya": "",
    "=": "=",
    "pi": "π",
    "-": "",
}

# Between the numbers of a range.
SEPARATORS = ["-", "–", "and", "and(-)", "or", "to", "to(-)", "to about", "+/-", "±", "+", ",", ", and", ", or", "by", "x"]

# Chinese forms in the order in which they are listed.
CHINESE = ["t", "s", "c", "p", "hp", "tp", "w", "j", "cy", "sl", "poj", "zhu", "l"]

# Parameters of height that aren't units.
NO_UNITS = ["precision", "frac", "abbr", "wiki", "out"]

# Olympic codes and English short names of countries (public lists of the IOC and of ISO 3166). Others can be given to expand().
COUNTRIES = {
    "afg": "Afghanistan", "alb": "Albania", "alg": "Algeria", "and": "Andorra", "ang": "Angola", "ant": "Antigua and Barbuda", "arg": "Argentina", "arm": "Armenia", "aru": "Aruba",
    "asa": "American Samoa", "aus": "Australia", "aut": "Austria", "aze": "Azerbaijan", "bah": "Bahamas", "ban": "Bangladesh", "bar": "Barbados", "bdi": "Burundi", "bel": "Belgium", "ben": "Benin",
    "ber": "Bermuda", "bhu": "Bhutan", "bih": "Bosnia and Herzegovina", "biz": "Belize", "blr": "Belarus", "bol": "Bolivia (Plurinational State of)", "bot": "Botswana", "bra": "Brazil",
    "brn": "Bahrain", "bru": "Brunei Darussalam", "bul": "Bulgaria", "bur": "Burkina Faso", "caf": "Central African Republic", "cam": "Cambodia", "can": "Canada", "cay": "Cayman Islands",
    "cgo": "Congo", "cha": "Chad", "chi": "Chile", "chn": "China", "civ": "Côte d'Ivoire", "cmr": "Cameroon", "cod": "Congo (Democratic Republic of the)", "cok": "Cook Islands", "col": "Colombia",
    "com": "Comoros", "cpv": "Cabo Verde", "crc": "Costa Rica", "cro": "Croatia", "cub": "Cuba", "cyp": "Cyprus", "cze": "Czechia", "den": "Denmark", "dji": "Djibouti", "dma": "Dominica",
    "dom": "Dominican Republic", "ecu": "Ecuador", "egy": "Egypt", "eri": "Eritrea", "esa": "El Salvador", "esp": "Spain", "est": "Estonia", "eth": "Ethiopia", "fij": "Fiji", "fin": "Finland",
    "fra": "France", "fsm": "Micronesia (Federated States of)", "gab": "Gabon", "gam": "Gambia", "gbr": "United Kingdom of Great Britain and Northern Ireland", "gbs": "Guinea-Bissau",
    "geo": "Georgia", "geq": "Equatorial Guinea", "ger": "Germany", "gha": "Ghana", "gre": "Greece", "grn": "Grenada", "gua": "Guatemala", "gui": "Guinea", "gum": "Guam", "guy": "Guyana",
    "hai": "Haiti", "hkg": "Hong Kong", "hon": "Honduras", "hun": "Hungary", "ina": "Indonesia", "ind": "India", "iri": "Iran (Islamic Republic of)", "irl": "Ireland", "irq": "Iraq", "isl": "Iceland",
    "isr": "Israel", "isv": "Virgin Islands (U.S.)", "ita": "Italy", "ivb": "Virgin Islands (British)", "jam": "Jamaica", "jor": "Jordan", "jpn": "Japan", "kaz": "Kazakhstan", "ken": "Kenya",
    "kgz": "Kyrgyzstan", "kir": "Kiribati", "kor": "Korea (Republic of)", "kos": "Kosovo", "ksa": "Saudi Arabia", "kuw": "Kuwait", "lao": "Lao People's Democratic Republic", "lat": "Latvia",
    "lba": "Libya", "lbn": "Lebanon", "lbr": "Liberia", "lca": "Saint Lucia", "les": "Lesotho", "lie": "Liechtenstein", "ltu": "Lithuania", "lux": "Luxembourg", "mad": "Madagascar", "mar": "Morocco",
    "mas": "Malaysia", "maw": "Malawi", "mda": "Moldova (Republic of)", "mdv": "Maldives", "mex": "Mexico", "mgl": "Mongolia", "mhl": "Marshall Islands", "mkd": "North Macedonia", "mli": "Mali",
    "mlt": "Malta", "mne": "Montenegro", "mon": "Monaco", "moz": "Mozambique", "mri": "Mauritius", "mtn": "Mauritania", "mya": "Myanmar", "nam": "Namibia", "nca": "Nicaragua", "ned": "Netherlands",
    "nep": "Nepal", "ngr": "Nigeria", "nig": "Niger", "nor": "Norway", "nru": "Nauru", "nzl": "New Zealand", "oma": "Oman", "pak": "Pakistan", "pan": "Panama", "par": "Paraguay", "per": "Peru",
    "phi": "Philippines", "ple": "Palestine, State of", "plw": "Palau", "png": "Papua New Guinea", "pol": "Poland", "por": "Portugal", "prk": "Korea (Democratic People's Republic of)",
    "pur": "Puerto Rico", "qat": "Qatar", "rou": "Romania", "rsa": "South Africa", "rus": "Russian Federation", "rwa": "Rwanda", "sam": "Samoa", "sen": "Senegal", "sey": "Seychelles",
    "sgp": "Singapore", "skn": "Saint Kitts and Nevis", "sle": "Sierra Leone", "slo": "Slovenia", "smr": "San Marino", "sol": "Solomon Islands", "som": "Somalia", "srb": "Serbia", "sri": "Sri Lanka",
    "ssd": "South Sudan", "stp": "Sao Tome and Principe", "sud": "Sudan", "sui": "Switzerland", "sur": "Suriname", "svk": "Slovakia", "swe": "Sweden", "swz": "Eswatini", "syr": "Syrian Arab Republic",
    "tan": "Tanzania, United Republic of", "tga": "Tonga", "tha": "Thailand", "tjk": "Tajikistan", "tkm": "Turkmenistan", "tls": "Timor-Leste", "tog": "Togo", "tpe": "Taiwan, Province of China",
    "tto": "Trinidad and Tobago", "tun": "Tunisia", "tur": "Türkiye", "tuv": "Tuvalu", "uae": "United Arab Emirates", "uga": "Uganda", "ukr": "Ukraine", "uru": "Uruguay",
    "usa": "United States of America", "uzb": "Uzbekistan", "van": "Vanuatu", "ven": "Venezuela (Bolivarian Republic of)", "vie": "Viet Nam", "vin": "Saint Vincent and the Grenadines", "yem": "Yemen",
    "zam": "Zambia", "zim": "Zimbabwe",
}


class Call:
    """One use of a template: its parts, its name as matched, and its parameters by key."""

    def __init__(self, source: str):
        self.parts = [trim(p) for p in source.split("|")]
        self.written = self.parts[0]
        self.name = trim(" ".join(w for w in self.written.split(" ") if w).lower())

    @cached_property
    def params(self) -> dict[str, str]:
        named: dict[str, str] = {}
        loose: list[str] = []
        for part in self.parts[1:]:
            key, *values = map(trim, part.split("="))
            if values:
                named[key] = values[0]
            else:
                loose.append(key)
        free = 1
        for value in loose:
            while str(free) in named:
                free += 1
            named[str(free)] = value
        return named

    def numbered(self) -> list[str]:
        """Values of whole-number keys, by number; of equal numbers the last by key."""
        found: dict[int, str] = {}
        for key in sorted(self.params):
            n = whole(key)
            if n is not None:
                found[n] = self.params[key]
        return [found[n] for n in sorted(found)]

    def digits(self) -> dict[str, str]:
        """Parameters whose key is digits only and whose value isn't empty."""
        return {k: v for k, v in self.params.items() if k.isdecimal() and v}

    def renamed(self, names: Iterable[str]) -> dict[str, str]:
        """Parameters with positions moved to the names that aren't given themselves, which take up no position."""
        out, position = dict(self.params), 1
        for name in names:
            if name not in out:
                if str(position) in out:
                    out[name] = out.pop(str(position))
                position += 1
        return out


_TOKEN = re.compile(r"\[|\]|\{([^{}]*)\}|[^\[\]{}]+")


@lru_cache(maxsize=None)
def _compiled(pattern: str) -> tuple:
    """Nested tuples: text, a tuple of keys for a parameter, or a list in a tuple for an optional part."""
    stack: list[list] = [[]]
    for m in _TOKEN.finditer(pattern):
        if m[0] == "[":
            stack.append([])
        elif m[0] == "]":
            part = stack.pop()
            stack[-1].append(("?", tuple(part)))
        elif m[0][0] == "{":
            stack[-1].append(("=", tuple(m[1].split("|"))))
        else:
            stack[-1].append(("", m[0]))
    return tuple(stack[0])


def _fill(parts: tuple, values: Mapping[str, str]) -> str | None:
    out = []
    for kind, what in parts:
        if kind == "?":
            out.append(_fill(what, values) or "")
        elif kind == "=":
            found = next((values[k] for k in what if k in values), None)
            if found is None:
                return None
            out.append(found)
        else:
            out.append(what)
    return "".join(out)


def first_of(patterns: Iterable[str], values: Mapping[str, str]) -> str | None:
    return next((s for p in patterns if (s := _fill(_compiled(p), values)) is not None), None)


def joined(separator: str, patterns: Iterable[str], values: Mapping[str, str]) -> str:
    return separator.join(s for p in patterns if (s := _fill(_compiled(p), values)) is not None)


# The names of templates and parameters in stated() and rule() below, and the words of their patterns.
Rule = Callable[[Call], str | None]
RULES: dict[str, Rule] = {}


def rule(*names: str) -> Callable[[Rule], Rule]:
    def add(f: Rule) -> Rule:
        RULES.update(dict.fromkeys(names, f))
        return f

    return add


def stated(names: str, *patterns: str, order: str = "", filled: bool = False) -> None:
    """Templates that patterns state; order names the positions; filled: empty values count as missing."""

    def by_pattern(call: Call) -> str | None:
        values = call.renamed(order.split()) if order else call.params
        return first_of(patterns, {k: v for k, v in values.items() if v} if filled else values)

    rule(*names.split(", "))(by_pattern)


def month(value: str | None, other: bool) -> str | None:
    """The name of a month's number; any other value as it is if other is set, else None."""
    n = whole(value) if value is not None else None
    if n is not None and 1 <= n <= 12:
        return MONTHS[n - 1]
    return value if other else None


def _with(values: dict[str, str], **more: str | None) -> dict[str, str]:
    return {k: v for k, v in (values | more).items() if v is not None}


stated("ss", "{1}[ ({2})]")
stated("censusau", "{1} census")
stated("nee", "née[ {1}]")
stated("rating", "{1}[/{2}]")
stated("player", "{1} {3}")
stated("rws, stnlnk", "{3|1}")
stated("sclass", "{1}-class {2}")
stated("small", "{1}")
stated("sortname", "{first}[ {last}]", order="first last")
stated("translation", "transl.[ {1}][ - transl. {2}]")
stated("dec", "[{1}°][{2}'][{3}'']")
stated("val", "{1}[ ± {2}]", "10 ^ {e}")
stated("alum", "{name}[ ({year})][: {nota}]", order="name year nota")
stated("visible anchor, vanchor, font", "{text}", order="text")
stated("bibleverse", "{text}", "{book}[, {verse}]", order="book verse version text")
stated("flagathlete", "{name} ({country})", order="name country")
stated("inflation", "{index} {value} ({start_year})", order="index value start_year")
stated("abbr, tooltip", "{text} ({meaning})", order="text meaning")
stated("color box", "[{text}]", order="color text")
stated("nihongo", "{english}({kanji}[, {extra1}])[ {extra2}]", "[{romaji}]({kanji}[, {romaji}][, {extra1}])[ {extra2}]", order="english kanji romaji extra1 extra2", filled=True)


@rule("m+j", "lang", "transl", "transliteration")
def _last(call: Call) -> str | None:
    return (call.numbered() or [None])[-1]


@rule("cast listing", "columns-list", "ct", "flag", "ill", "interlanguage link", "interlanguage link multi", "mesh", "stn", "station", "sup")
def _first(call: Call) -> str | None:
    return (call.numbered() or [None])[0]


@rule("airport codes", "au", "hlist", "linktext", "minor planet", "mp", "nflplayer", "post-nominals", "postnominals", "ship")
def _spaced(call: Call) -> str:
    return " ".join(call.numbered())


@rule("not a typo", "typo", "proper name", "chem name", "as written")
def _together(call: Call) -> str:
    return "".join(call.numbered())


@rule("rlp")
def _listed(call: Call) -> str:
    return ", ".join(call.numbered())


@rule("ordered list", "unbulleted list", "ubl")
def _stacked(call: Call) -> str:
    return "\n".join(call.numbered())


@rule("isbn")
def _isbn(call: Call) -> str:
    return ", ".join(v for _, v in sorted((int(k), v) for k, v in call.digits().items()))


@rule("sic")
def _sic(call: Call) -> str:
    return "".join(v for v in call.numbered() if v != "?")


@rule("jct")
def _junction(call: Call) -> str:
    roads = call.numbered()
    return "/".join("-".join(roads[i : i + 2]) for i in range(0, len(roads), 2))


@rule("nowrap", "mvar")
def _raw(call: Call) -> str:
    return "".join(call.parts[1:])


@rule("uss", "hms", "hmnzs")
def _vessel(call: Call) -> str | None:
    given = dict(zip("012", call.parts, strict=False))
    return first_of(["{0} {1}"] if len(call.parts) == 2 else ["{0} {1} ({2})"], given)


@rule("c.", "circa")
def _circa(call: Call) -> str | None:
    return first_of(["{0}[ {1}[-{2}]]"], call.params | {"0": call.written})


@rule("frac", "fraction")
def _fraction(call: Call) -> str | None:
    by_count = ["/", "1/{1}", "{1}/{2}", "{1} {2}/{3}"]
    return first_of(by_count[len(call.params) :][:1], call.params)


@rule("cvt", "convert")
def _measure(call: Call) -> str | None:
    return first_of(["{1} {2} {3} {4}" if call.params.get("2") in SEPARATORS else "{1} {2}"], call.params)


@rule("ra")
def _ascension(call: Call) -> str:
    return joined(" ", ["{1}h", "{2}m", "{3}s"], call.params)


def _quoted(values: dict[str, str], text: str, character: str) -> str | None:
    said = first_of([text], values)
    if said is None:
        return None
    caption = joined(", ", ["{author|sign}", "{title}", "{source}"], values)
    if character in values:
        caption = f"{values[character]}, in {caption}" if caption else values[character]
    return f'"{said}"-{caption}' if caption else said


@rule("blockquote", "quotation", "quote", "quote box", "cquote")
def _quote(call: Call) -> str | None:
    return _quoted(call.renamed(["text", "author", "source"]), "{text|quote|quotetext|content}", "character")


@rule("poemquote", "poem quote")
def _poem(call: Call) -> str | None:
    return _quoted(call.renamed(["text"]), "{text}", "char")


@rule("as of", "asof")
def _as_of(call: Call) -> str | None:
    values = call.renamed(["year", "month", "day"])
    if "alt" in values:
        return values["alt"]
    lead = "Since" if values.get("since") == "y" else "As of" if call.written.startswith("A") else "as of"
    values = _with(values, lead=lead, month=month(values.get("month"), other=True))
    return trim(first_of(["{lead}[ {day}][ {month}][ {year}]"], values) or "") + (first_of(["[{post} ]"], values) or "")


@rule("coord", "coordinates", "location")
def _coordinates(call: Call) -> str | None:
    kept = sorted((k, v) for k, v in call.digits().items() if ":" not in v)  # by key as text
    v = {str(i): value for i, (_, value) in enumerate(kept)}
    if len(v) == 2:
        # Kept as it is known to be computed: the second figure is the first one again, without its first character where the second is negative.
        north, east = not v["0"].startswith("-"), not v["1"].startswith("-")
        v |= {"lat": v["0"] if north else v["0"][1:], "ns": "N" if north else "S", "lon": v["0"] if east else v["0"][1:], "ew": "E" if east else "W"}
    forms = {2: "{lat}°{ns} {lon}°{ew}", 4: "{0}°{1} {2}°{3}", 6: "{0}°{1}'{2} {3}°{4}'{5}", 8: "{0}°{1}'{2}\"{3} {4}°{5}'{6}\"{7}"}
    return first_of([forms[len(kept)]], v) if len(kept) in forms else None


@rule("start date", "start date and age", "end date")
def _moment(call: Call) -> str | None:
    values = {k: v for k, v in call.renamed(["year", "month", "day", "hour", "minute", "second", "timezone"]).items() if v}
    number = whole(values.get("month", ""))
    values = _with(values, month=month(values.get("month"), other=True) if number is not None else None, timezone="UTC" if values.get("timezone") == "Z" else values.get("timezone"))
    return first_of(["[{hour}:{minute}[:{second}], ][{month}[ {day},] ][{year}][ ({timezone})]"], values)


@rule("film date")
def _release(call: Call) -> str | None:
    values = call.renamed(["year", "month", "day"])
    return first_of(["[{month} ][{day}, ]{year}"], _with(values, month=month(values.get("month"), other=False)))


@rule("birth date and age", "bda", "death date and age", "birth date", "birth date and age2")
def _life(call: Call) -> str | None:
    values = call.renamed(["year", "month", "day"])
    return first_of(["[{month}[ {day}], ]{year}"], _with(values, month=month(values.get("month"), other=True)))


@rule("zh")
def _chinese(call: Call) -> str:
    return "; ".join(call.params[k] for k in CHINESE if call.params.get(k))


@rule("korean", "ko-hhrm")
def _korean(call: Call) -> str:
    return joined("; ", ["Korean: {hangul}", "Hanja: {hanja}", "RR: {rr}", "MR: {mr}"], call.renamed(["hangul", "hanja", "rr", "mr"]))


@rule("ushr")
def _district(call: Call) -> str | None:
    values = call.renamed(["state", "number"])
    place = "at-large" if values.get("number") == "AL" else "{number}th"
    return first_of([f"{{state}}'s {place} congressional district"], values)


@rule("height")
def _height(call: Call) -> str:
    return " ".join(f"{v} {k}" for k, v in sorted(call.params.items()) if k not in NO_UNITS)


def _olympic(call: Call, countries: Mapping[str, str]) -> str | None:
    if call.name.endswith(("athlete", "medalist")):
        return first_of(["{1} ({2})"], call.params)
    code = call.params.get("1")
    return None if code is None else countries.get(code.lower(), code)


def expand(source: str, countries: Mapping[str, str] = COUNTRIES) -> str | None:
    """The plain text of what stands between {{ and }}; None for a template that isn't known."""
    call = Call(source)
    if call.name in CONSTANTS:
        return CONSTANTS[call.name]
    if call.name in RULES:
        return RULES[call.name](call)
    if call.name.startswith("lang"):
        return _last(call)
    if call.name.startswith("flagioc"):
        return _olympic(call, countries)
    return None

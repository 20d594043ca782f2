"""String helpers whose rules differ from Python's own."""

from __future__ import annotations

import re

#: Unicode's White_Space characters; str.strip() would also take U+001C to U+001F.
WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_WHOLE = re.compile(r"\+?[0-9]+", re.ASCII)


def trim(s: str) -> str:
    return s.strip(WHITE)


def whole(s: str) -> int | None:
    """A non-negative whole number below 2 ** 64 in ASCII digits, or None."""
    if not _WHOLE.fullmatch(s):
        return None
    n = int(s)
    return n if n < 1 << 64 else None


def lines(s: str) -> list[str]:
    """Cut at line feeds only, each line without one carriage return at its end."""
    found = s.split("\n")
    if found[-1] == "":
        found.pop()
    return [x[:-1] if x.endswith("\r") else x for x in found]

"""Namespaces of titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Subject and talk namespaces (the main one has no name), and virtual ones.
NAMESPACES = [
    "Talk", "User", "User talk", "Wikipedia", "Wikipedia talk", "File", "File talk", "MediaWiki", "MediaWiki talk", "Template", "Template talk", "Help", "Help talk",
    "Category", "Category talk", "Portal", "Portal talk", "Draft", "Draft talk", "TimedText", "TimedText talk", "Module", "Module talk", "Special", "Media",
]
# Other names of namespaces, with what they stand for.
ALIASES = {"WP": "Wikipedia", "WT": "Wikipedia talk", "Project": "Wikipedia", "Project talk": "Wikipedia talk", "Image": "File", "Image talk": "File talk"}
# Prefixes of shortcuts, which stay in the main namespace.
PSEUDO = ["CAT", "H", "MOS", "P"]


def namespace(title: Column) -> Column:
    """The namespace that a title's prefix names, aliases resolved; empty for the main one."""
    prefix = F.substring_index(title, ":", 1)
    known = F.create_map(*[F.lit(x) for n in NAMESPACES for x in (n, n)], *[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.when(F.contains(title, F.lit(":")), F.coalesce(F.try_element_at(known, prefix), F.lit(""))).otherwise("")


def is_shortcut(title: Column) -> Column:
    return F.contains(title, F.lit(":")) & F.substring_index(title, ":", 1).isin(PSEUDO)

"""Link extraction with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bar(span: Column) -> Column:
    """The position of the first | with as many { as } before it; null without one. The parts between bars are looked at once each."""
    state = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bar"))

    def step(seen: Column, part: Column) -> Column:
        size = F.length(part)
        depth = seen["depth"] + F.length(F.replace(part, F.lit("}"), F.lit(""))) - F.length(F.replace(part, F.lit("{"), F.lit("")))
        at = seen["at"] + size + 1
        return F.struct(depth.alias("depth"), at.alias("at"), F.coalesce(seen["bar"], F.when(depth == 0, at)).alias("bar"))

    found = F.aggregate(F.split(span, "\\|"), state, step, lambda seen: seen["bar"])
    return F.when(found <= F.length(span), found)


def link(span: Column) -> Column:
    """struct(target, label) of what stands between [[ and ]]; without a bar both are the whole."""
    simple = (F.instr(span, "{") == 0) & (F.instr(span, "}") == 0)
    at = F.when(simple, F.nullif(F.instr(span, "|"), F.lit(0))).otherwise(_bar(span))  # the scan by parts is needed with braces only
    return F.struct(
        F.when(at.isNull(), span).otherwise(F.substring(span, F.lit(1), at - 1)).alias("target"),
        F.when(at.isNull(), span).otherwise(F.substring(span, at + 1, F.length(span))).alias("label"),
    )


def extract_links(text: Column) -> Column:
    """array<struct<target, label>> of [[...]], each up to the first ]]; nothing is trimmed, folded or left out.

    What stands behind the last ]] is cut off first, so that no search for one runs to the end in vain.
    """
    text = F.coalesce(text, F.lit(""))
    behind = F.instr(F.reverse(text), "]]")
    closed = F.when(behind > 0, F.substring(text, F.lit(1), F.length(text) - behind + 1)).otherwise("")
    return F.transform(F.regexp_extract_all(closed, F.lit(r"(?s)\[\[(.*?)\]\]"), F.lit(1)), link)


def page_links(pages: DataFrame) -> DataFrame:
    """pages(title, text) as (title, links): a narrow transformation without Python."""
    return pages.select("title", extract_links(F.col("text")).alias("links"))

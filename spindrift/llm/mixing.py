"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut, hidden, prefixed, running, shown, small, stored, unit


@dataclass(frozen=True)
class Settings:
    """epochs: how often a source may be repeated at most. weights: given in turn to the sources by code point, null
    last. seed: of the order in which documents are drawn. per_bucket: rows that meet in one window."""

    epochs: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    seed: int = 17
    per_bucket: int = 5_000


def words(text: Column) -> Column:
    """The number of runs of other characters than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """sizes(source, source_size, n) with rank (by code point, from 0), weight and target.

    Each round shares what the clamped sources leave among the others by weight, and clamps those that it would take
    past epochs x size, until there are none: two sums a round, over a table of one row a source. A source of size 0 has target 0.
    """
    sizes = cut(sizes)
    ranked = prefixed(sizes.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()], "_one", "rank", sizes.count())
    weight = F.get(F.array(*[F.lit(float(w)) for w in settings.weights]), F.col("rank") % len(settings.weights))
    s = cut(ranked.drop("_one").withColumn("weight", weight).withColumn("cap", F.lit(float(settings.epochs)) * F.col("source_size")))
    total, level, clamped = s.agg(F.sum("source_size")).first()[0] or 0, 0.0, -1
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        caps, weights, count = s.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if count == clamped or not weights:
            break
        level, clamped = (total - (caps or 0.0)) / weights, count
    return s.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).select("source", "rank", "source_size", "n", "weight", "target")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", settings: Settings = Settings(), keep_text: bool = True) -> DataFrame:
    """docs with size, source_size, target, repeats and taken (replacing columns of these names); without the text, unless it is kept.

    A source takes target / size of itself: the whole repetitions of every document, and one more of those that come
    first in a seeded order until the fraction is filled; the document at the fraction's edge is taken if more than
    half of it is inside. So a source misses its target by half a document at most and no document is repeated more
    than epochs times. The order is by a hash of key, then size; its running sums go by buckets of it, so that a hot
    source is spread, and where one key's rows crowd a bucket, rows are dealt by their own number. The rows are written
    once and read for each sum. Equal rows are interchangeable; null keys and null sources are values like others; a
    text without words has size 0 and is repeated like any other; an empty table gives an empty one.
    """
    plain, names = hidden(docs)
    kept = {name: c for name, c in names.items() if keep_text or name != text}
    d = plain.select(*kept.values(), words(F.col(names[text])).alias("_size"), F.monotonically_increasing_id().alias("_row"))
    d = stored(d, "mixing-rows")
    key, source = names[key], names[source]
    per = targets(d.groupBy(F.col(source).alias("source")).agg(F.sum("_size").alias("source_size"), F.count("*").alias("n")), settings)
    # Of each source only the whole repetitions and the fraction are needed from here on.
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = per.withColumn("_whole", F.floor(ratio)).withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size")).withColumn("_buckets", F.ceil(F.col("n") / settings.per_bucket))
    per = cut(per.select(F.col("source").alias("_source"), F.col("rank").alias("_rank"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "_whole", "_left", "_buckets"))
    d = d.join(small(per, per.count()), F.col(source).eqNullSafe(F.col("_source"))).withColumn("_u", unit(key, seed=settings.seed))
    d = running(d, ["_rank"], ["_u", "_size"], "_size", "_upto", bucket=F.floor(F.col("_u") * F.col("_buckets")), salt=unit("_row", seed=settings.seed), crowd=4 * settings.per_bucket)
    extra = F.when((F.col("_left") > 0) & (F.col("_upto") + F.col("_size") / 2 <= F.col("_left")), 1).otherwise(0)
    repeats = (F.col("_whole") + extra).cast("int")
    made = {"size": F.col("_size"), "source_size": F.col("_source_size"), "target": F.col("_target"), "repeats": repeats, "taken": (repeats * F.col("_size")).cast("long")}
    return d.select(*shown(kept, [*made]), *[c.alias(name) for name, c in made.items()])


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as repeats says, with copy_no from 0."""
    return mixed.filter("repeats > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)))

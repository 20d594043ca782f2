"""Versioned dimension merge: changes folded by time slices, whose summaries form a short chain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindrift.llm.shared import small, stored

_HOUR = 3_600_000_000


@dataclass(frozen=True)
class Settings:
    """inherit: an update's null attribute takes the value that holds, as far back as the last delete or insert; else it
    is null. slices: widths in microseconds, each a multiple of the next. crowd: instants of a key that a slice may
    hold; one of more is cut to the next width."""

    inherit: bool = False
    slices: tuple[int, ...] = (168 * _HOUR, _HOUR, _HOUR // 60)
    crowd: int = 50_000


def _sliced(instants: DataFrame, settings: Settings) -> DataFrame:
    """instants with slice, the start of its time slice. A week of a key that holds more than a crowd is cut to hours, and
    such an hour to minutes: so the slices of a key are bounded by the time that the data span, not by their rows."""
    start = lambda width: F.floor(F.col("at") / width) * width
    out = instants.withColumn("slice", start(settings.slices[0]))
    for width in settings.slices[1:]:
        crowded = out.groupBy("key", "slice").count().filter(F.col("count") > settings.crowd)
        if not (n := crowded.count()):
            break
        crowded = small(crowded.select("key", "slice", F.lit(True).alias("crowded")), n, limit=20_000)
        out = out.join(crowded, ["key", "slice"], "left").withColumn("slice", F.when(F.col("crowded"), start(width)).otherwise(F.col("slice"))).drop("crowded")
    return out


def _instants(rows: DataFrame, names: list[str]) -> DataFrame:
    """(key, at, row, n, several): for each instant of a key the row that counts there, if any, the number of changes that
    occur only there, and whether a change first occurs there that occurs elsewhere too.

    Rows of equal seq or instant meet in aggregates, which each task begins before the shuffle; so a key, a seq or an
    instant of most rows goes through no one task.
    """
    body = ["op", *names]
    first = F.min(F.struct(F.col("change").isNull().alias("unnamed"), "change", "at", *body)).alias("r")
    of_seq = rows.groupBy("key", "seq").agg(first).select("key", F.col("r.at").alias("at"), F.struct("seq", *[F.col(f"r.{c}").alias(c) for c in body]).alias("row"), F.lit(0).alias("n"), F.lit(False).alias("several"))
    spans = rows.filter("change IS NOT NULL").groupBy("key", "change").agg(F.min("at").alias("at"), F.max("at").alias("until"))
    told = spans.select("key", "at", F.lit(None).cast(of_seq.schema["row"].dataType).alias("row"), (F.col("at") == F.col("until")).cast("int").alias("n"), (F.col("at") < F.col("until")).alias("several"))
    return of_seq.unionByName(told).groupBy("key", "at").agg(F.max("row").alias("row"), F.sum("n").alias("n"), F.max("several").alias("several"))


def _folded(instants: DataFrame, names: list[str], settings: Settings) -> DataFrame:
    """instants, of sliced time, with the state that holds from each as far as its slice tells: every field is a struct of
    its value, or null where the slice inherits it. piece numbers a slice's runs of equal such states."""
    to_here = Window.partitionBy("key", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("key", "slice").orderBy("at")
    op, deletes = F.col("row.op"), F.col("row.op") == "D"

    def held(field: str) -> Column:
        value, sets = F.col(f"row.{field}"), op.isin("D", "I", "U")
        if settings.inherit:
            sets = op.isin("D", "I") | ((op == "U") & value.isNotNull())
        return F.last(F.when(sets, F.struct(F.when(~deletes, value).alias("v"))), ignorenulls=True).over(to_here)

    told = F.last(F.when(op.isin("D", "I", "U"), F.struct(deletes.alias("v"))), ignorenulls=True).over(to_here)
    out = instants.withColumn("state", F.struct(told.alias("deleted"), *[held(c).alias(c) for c in names]))
    out = out.withColumn("begins", (~F.col("state").eqNullSafe(F.lag("state").over(before)) | F.lag("at").over(before).isNull()).cast("int"))
    return out.withColumn("piece", F.sum("begins").over(to_here))


def _resolved(pieces: DataFrame, names: list[str]) -> DataFrame:
    """pieces with the state that they have, inherited fields taken from the slices before, and whether it differs from the state before."""
    fields = ["deleted", *names]
    last = pieces.groupBy("key", "slice").agg(F.max_by("state", "piece").alias("state"))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    chain = last.select("key", "slice", F.struct(*[F.last(f"state.{c}", ignorenulls=True).over(earlier).alias(c) for c in fields]).alias("given"))
    found = pieces.join(chain, ["key", "slice"])
    value = lambda c: F.coalesce(F.col(f"state.{c}"), F.col(f"given.{c}"))["v"].alias(c)
    found = found.withColumn("now", F.struct(*map(value, fields)))
    given = F.struct(*[F.col(f"given.{c}")["v"].alias(c) for c in fields])
    within = Window.partitionBy("key", "slice").orderBy("piece")
    differs = ~F.col("now").eqNullSafe(F.coalesce(F.lag("now").over(within), given))
    return found.withColumn("starts", F.coalesce(F.col("now.deleted").isNotNull() & differs, F.lit(False))).drop("state", "given")


def _numbered(pieces: DataFrame) -> DataFrame:
    """pieces with the version that holds there (0: none yet), and where the next one starts."""
    start = F.when(F.col("starts"), F.col("at"))
    sums = pieces.groupBy("key", "slice").agg(F.sum(F.col("starts").cast("int")).alias("own"), F.min(start).alias("first"))
    chain = Window.partitionBy("key").orderBy("slice")
    sums = sums.select(
        "key", "slice", F.coalesce(F.sum("own").over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.min("first").over(chain.rowsBetween(1, Window.unboundedFollowing)).alias("next")
    )
    within = Window.partitionBy("key", "slice").orderBy("piece")
    version = F.col("base") + F.sum(F.col("starts").cast("int")).over(within.rowsBetween(Window.unboundedPreceding, 0))
    until = F.coalesce(F.min(start).over(within.rowsBetween(1, Window.unboundedFollowing)), F.col("next"))
    return pieces.join(sums, ["key", "slice"]).withColumn("version", version.cast("int")).withColumn("until", until)


def merge(changes: DataFrame, key: str, at: Column, seq: str, change: str, op: str, attributes: Mapping[str, Column], settings: Settings = Settings()) -> DataFrame:
    """The versions of every key: (key's name, version, valid_from, valid_to, is_deleted, attributes, first_seq, n_changes).

    at is the instant of a change in microseconds, a long; rows without one take no part. Of a key's rows of equal seq
    that of the smallest change stays (nulls last; of equal ones the least by instant, op and attributes, nulls first),
    and of these, at one instant, that of the largest seq. In order of time D deletes, I and U set the attributes, and
    any other op or none changes nothing. Consecutive equal states, where null equals null, are one version, numbered
    from 1, from valid_from to valid_to in microseconds, null where it is open. first_seq is the seq that counts at
    valid_from, n_changes the number of the key's different changes, dropped ones too but not null, inside. Null keys
    are one key, null seqs one seq; repeated rows count once; an empty table gives no row. Other columns aren't read,
    so their names don't matter.

    A key's time is cut to slices, of a week each; a slice folds by itself, and what it inherits stays open. The last
    states of a key's slices form a short chain, which says what each inherits; by joins with it states are resolved,
    equal ones at the slices' borders are stitched, and versions numbered. No task sees a key's rows as a whole.
    """
    names = [f"a{i}" for i in range(len(attributes))]
    # A struct is not null where its field is, so null keys join and group as any other.
    rows = changes.select(F.struct(F.col(key).alias("k")).alias("key"), at.alias("at"), F.col(seq).alias("seq"), F.col(change).alias("change"), F.col(op).alias("op"), *[c.alias(n) for n, c in zip(names, attributes.values(), strict=True)]).filter("at IS NOT NULL")
    instants = stored(_instants(rows, names), "instants")
    several = None
    if instants.filter("several").head(1):
        # A change at several instants counts once in a version: it is looked up where it occurs.
        spans = rows.filter("change IS NOT NULL").groupBy("key", "change").agg(F.min("at").alias("low"), F.max("at").alias("high")).filter("low < high")
        several = stored(rows.select("key", "change", "at").join(spans.select("key", "change"), ["key", "change"]).distinct(), "several")
        more = several.select("key", "at", F.lit(None).cast(instants.schema["row"].dataType).alias("row"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("several"))
        instants = instants.unionByName(more).groupBy("key", "at").agg(F.max("row").alias("row"), F.sum("n").alias("n"), F.max("several").alias("several"))
    folded = _folded(_sliced(instants, settings), names, settings)
    if several is not None:
        folded = stored(folded.select("key", "slice", "at", "row", "n", "several", "state", "piece"), "folded")
    least = F.min(F.struct("at", F.col("row.seq").alias("seq"), "state")).alias("r")
    pieces = stored(folded.groupBy("key", "slice", "piece").agg(least, F.sum("n").alias("n")).select("key", "slice", "piece", "r.at", "r.seq", "r.state", "n"), "pieces")
    found = _numbered(_resolved(pieces, names)).filter("version > 0")
    parts = found.select("key", "version", "n", F.when(F.col("starts"), F.struct("at", "until", "now", "seq")).alias("v"))
    if several is not None:
        found = stored(found, "numbered")
        parts = found.select("key", "version", "n", F.when(F.col("starts"), F.struct("at", "until", "now", "seq")).alias("v"))
        places = folded.filter("several").select("key", "slice", "piece", "at").join(found.select("key", "slice", "piece", "version"), ["key", "slice", "piece"]).select("key", "at", "version")
        once = several.join(places, ["key", "at"]).select("key", "version", "change").distinct()
        parts = parts.unionByName(once.groupBy("key", "version").agg(F.count("*").alias("n")), allowMissingColumns=True)
    out = parts.groupBy("key", "version").agg(F.max("v").alias("v"), F.sum("n").alias("n"))
    return out.select(
        F.col("key.k").alias(key), "version", F.col("v.at").alias("valid_from"), F.col("v.until").alias("valid_to"), F.col("v.now.deleted").alias("is_deleted"),
        *[F.col(f"v.now.{n}").alias(c) for n, c in zip(names, attributes, strict=True)], F.col("v.seq").alias("first_seq"), F.col("n").alias("n_changes"),
    )


def micros(df: DataFrame, column: str) -> Column:
    """A timestamp, with a zone or without one, in which it is UTC, as microseconds since 1970."""
    if dict(df.dtypes)[column] == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column))
    return F.unix_micros(F.col(column))

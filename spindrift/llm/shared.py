"""What the operators share: the shared folder, sizes checked before a broadcast, prefix sums, connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that may be broadcast: at most this many of a few dozen bytes each.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, that driver and executors share; one under the temporary folder where none is
    set and all run in one process, as in tests. A cluster without one is an error: executors would write to their own disks."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{os.path.join(tempfile.gettempdir(), 'spindrift-checkpoints')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch_root(spark: SparkSession) -> str:
    """What this application writes to the shared folder lies here, but for checkpoints."""
    return f"{shared_dir(spark).rstrip('/')}/spindrift/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Removes what this application's operators have written to the shared folder: call it once their results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_PASSING: ContextVar[list[str] | None] = ContextVar("_PASSING", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What stored() writes meanwhile is removed at the end: for steps whose result stands by itself by then, as cut() or an
    action makes it. So are shuffle files that nothing refers to any more: Spark removes them as the driver's JVM collects
    garbage, which a driver with little to do puts off."""
    paths: list[str] = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()  # data frames that Python still holds in cycles keep their plans alive
        for _ in range(2):  # what the first collection frees refers to the rest
            spark._jvm.System.gc()
            time.sleep(0.5)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000, size: int = 16 << 20) -> Iterator[None]:
    """While it is open at most this many rows, and bytes unless a row has more, go to Python at once, as a batch of whole
    texts is held several times, on both sides; then the session's own settings are back. A plan takes the settings that hold when it runs."""
    names = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before = [spark.conf.get(name) for name in names]
    if not 0 < int(before[0]) <= rows:
        spark.conf.set(names[0], str(rows))
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[1]) <= size:
        spark.conf.set(names[1], str(size))
    try:
        yield
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)


def release() -> None:
    """Gives what a task's Python worker no longer uses back to the system: the worker stays for other tasks, and stages of a pipeline share it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written as Parquet to the shared folder and read again: the plan behind it ends here and survives lost
    executors. rows: that go to Python at once meanwhile; none: as the session says."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with short_batches(spark, rows) if rows else nullcontext():
        df.write.parquet(path)
    if (paths := _PASSING.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """df, shuffled once by a column into as many buckets as a shuffle has partitions, written to the shared folder and read
    again: what is joined with it by that column comes to its buckets, and it isn't shuffled again, however large either is."""
    spark = df.sparkSession
    n, path, table = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch(spark, name), f"spindrift_{uuid.uuid4().hex}"
    df.repartition(n, by).write.format("parquet").bucketBy(n, by).option("path", path).saveAsTable(table)
    if (paths := _PASSING.get()) is not None:
        paths.append(path)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay, and found knows of its buckets
    return found


def cut(df: DataFrame) -> DataFrame:
    """df by checkpoint() in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows are within limit; without one the planner joins by a shuffle. For rows of a few numbers or short strings."""
    return F.broadcast(df) if rows <= limit else df


def unit(*cols: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only, from 52 bits of MD5, which SQL engines share."""
    text = F.concat_ws("\x1f", F.lit(str(seed)), *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\x00")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def fresh(df: DataFrame, name: str) -> str:
    """name, or with underscores before it one that df has no column of."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def hidden(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns named c0, c1, ..., and these by their own names: so no column of a caller's meets one of an operator's."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), {c: f"c{i}" for i, c in enumerate(df.columns)}


def shown(names: dict[str, str], without: list[str] = []) -> list[Column]:  # noqa: B006
    """The columns of hidden() by their own names, some left out."""
    return [F.col(c).alias(name) for name, c in names.items() if name not in without]


def dealt(df: DataFrame, part: list[str], value: str, bucket: Column, salt: Column | None, crowd: int, depth: int = 0) -> tuple[DataFrame, DataFrame]:
    """df with its bucket and sub-bucket as _bucket and _sub, and the sums of value by them as _own.

    The sub-bucket is 0, but in a bucket of more than crowd rows, which a key repeated often makes: there salt, a number
    in [0, 1) of each row's own, deals the rows to so many sub-buckets that one holds about a quarter of crowd.
    """
    b, s, own, rows, parts = (f"_{x}{depth}" for x in ("bucket", "sub", "own", "rows", "parts"))

    def sums(of: DataFrame) -> DataFrame:
        return cut(of.groupBy(*part, b, s).agg(F.sum(value).alias(own), F.count("*").alias(rows)))

    df = df.withColumn(b, bucket.cast("long")).withColumn(s, F.lit(0).cast("long"))
    found = sums(df)
    if salt is None or not (crowded := found.filter(F.col(rows) > crowd)).head(1):
        return df, found.drop(rows)
    crowded = crowded.select(*part, b, F.ceil(F.col(rows) * 4 / crowd).alias(parts))
    df = df.join(small(crowded, crowded.count()), [*part, b], "left").withColumn(s, F.coalesce(F.floor(salt * F.col(parts)), F.lit(0)).cast("long")).drop(parts)
    return df, sums(df).drop(rows)


def running(df: DataFrame, part: list[str], order: list, value: str, out: str, bucket: Column, group: int = 0, depth: int = 0, salt: Column | None = None, crowd: int = 20_000) -> DataFrame:
    """Adds out: the sum of value over the rows of the same part that come before in the order of (bucket, *order).

    A window over a whole part would put a hot part in one task. Here bucket, an integer that never falls along the
    order wanted, deals the rows; the buckets' sums are summed over a table of one row a bucket (with group, by groups
    of so many buckets first), and only a bucket's own rows meet in a window. With salt, in buckets of more than crowd
    rows its order comes first, and deals them again (see dealt()). part's columns must not be null.
    """
    b, s, own, base = (f"_{x}{depth}" for x in ("bucket", "sub", "own", "base"))
    df, sums = dealt(df, part, value, bucket, salt, crowd, depth)
    if group:
        sums = running(sums, part, [b, s], own, base, F.floor(F.col(b) / group), depth=depth + 1)
    else:
        over = Window.partitionBy(*part).orderBy(b, s).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn(base, F.coalesce(F.sum(own).over(over), F.lit(0)))
    inner = Window.partitionBy(*part, b, s).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn(own, F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return within.join(sums.select(*part, b, s, base), [*part, b, s]).withColumn(out, F.col(own) + F.col(base)).drop(b, s, own, base)


def prefixed(df: DataFrame, order: list[Column], value: str, out: str, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df, of so many rows that differ in order, with out: the sum of value over the rows before. Up to limit rows meet in
    one window; more are dealt by ranges of the order, and the ranges' sums are summed."""
    if rows <= limit:
        over = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(value).over(over), F.lit(0)))
    ranges = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    return running(ranges, [], order, value, out, F.col("_range"), group=4096).drop("_range")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges(a, b): component is the smallest node that links reach.

    Large-star and small-star steps alternate until nothing changes; each keeps at most one edge a node and step, pairs
    of a component are never listed, and every round is written to the shared folder. The stars' centres are minima by
    groupBy, so that a hot centre is summed before the shuffle.
    """
    spark = edges.sparkSession
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = cut(now)
    before = None
    for _ in range(rounds):
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "_u")
        large = both.filter("v > u").join(least, both["u"] == least["_u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        joined = large.join(least, large["u"] == least["_u"])
        now = cut(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("_u").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct())
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    out = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return out.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))

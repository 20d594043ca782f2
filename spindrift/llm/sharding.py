"""Hilbert-curve sharding: rows sorted by their place on a curve through several quantised dimensions, cut into runs.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut, hidden, prefixed, running, shown, small, stored, unit


@dataclass(frozen=True)
class Settings:
    """shards: runs to cut. bits: of each dimension; 2 ** (bits x dimensions) cells at most. per_bucket: rows that meet in
    one window. seed: of the order in a cell."""

    shards: int = 16
    bits: int = 5
    per_bucket: int = 5_000
    seed: int = 29


def hilbert(cells: DataFrame, dims: list[str], bits: int, name: str) -> DataFrame:
    """cells with the index on the Hilbert curve of the point that the integer columns dims hold, each below 2 ** bits.

    The point's axes are taken to the curve's transposed form by exclusive ors from the highest bit down (Skilling,
    2004), made Gray code, and their bits interleaved. Each step is a projection of its own, so that no expression
    is written out twice.
    """
    n, others = len(dims), [c for c in cells.columns if c not in dims]
    df = cells.select(*others, *dims, *[F.col(c).cast("long").alias(f"_x{i}") for i, c in enumerate(dims)])

    def step(df: DataFrame, **new: Column) -> DataFrame:
        return df.select(*others, *dims, *[new.get(f"_x{i}", F.col(f"_x{i}")).alias(f"_x{i}") for i in range(n)])

    x = [F.col(f"_x{i}") for i in range(n)]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            low = F.lit(q - 1).cast("long")
            swap = x[0].bitwiseXOR(x[i]).bitwiseAND(low)
            hit = x[i].bitwiseAND(F.lit(q).cast("long")) != 0
            if i == 0:
                df = step(df, _x0=F.when(hit, x[0].bitwiseXOR(low)).otherwise(x[0]))
            else:
                df = step(df, **{"_x0": F.when(hit, x[0].bitwiseXOR(low)).otherwise(x[0].bitwiseXOR(swap)), f"_x{i}": F.when(hit, x[i]).otherwise(x[i].bitwiseXOR(swap))})
    for i in range(1, n):
        df = step(df, **{f"_x{i}": x[i].bitwiseXOR(x[i - 1])})
    turn = F.lit(0).cast("long")
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn = turn.bitwiseXOR(F.when(x[n - 1].bitwiseAND(F.lit(q).cast("long")) != 0, F.lit(q - 1)).otherwise(F.lit(0)).cast("long"))
    df = step(df.withColumn("_t", turn).select(*others, *dims, *[x[i].bitwiseXOR(F.col("_t")).alias(f"_x{i}") for i in range(n)]))
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index * 2 + F.shiftright(x[i], b).bitwiseAND(F.lit(1).cast("long"))
    return df.select(*others, *dims, index.alias(name))


def quantised(df: DataFrame, dims: list[str], settings: Settings) -> DataFrame:
    """df with each column of dims made an integer below 2 ** bits, in the values' order, with about equal rows in each step.

    A value's step is that of the rows below it, counted exactly; so equal values share a step. Strings go by code point,
    null and NaN stand below all.
    """
    steps = 1 << settings.bits
    for d in dims:
        if dict(df.dtypes)[d] in ("float", "double"):
            df = df.withColumn(d, F.when(~F.isnan(d), F.col(d)))
        per = cut(df.groupBy(d).agg(F.count("*").alias("_n")))
        total, values = per.agg(F.sum("_n"), F.count("*")).first()
        per = cut(prefixed(per, [F.col(d).asc_nulls_first()], "_n", "_upto", values).select(F.col(d).alias("_v"), F.floor(F.col("_upto") * steps / F.lit(total)).alias("_q")))
        df = df.join(small(per, values), F.col(d).eqNullSafe(F.col("_v"))).withColumn(d, F.col("_q")).drop("_v", "_q")
    return df


def shard(docs: DataFrame, dims: dict[str, Column], key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """docs with hilbert, shard and slot (replacing columns of these names): counts of shards are at most one apart.

    Rows are ranked by their cell on the curve, and in a cell by a seeded hash of key, then key; shard s holds the ranks
    from s x rows / shards on, slot counts from 0 in it. A cell of many rows is dealt to several windows by that hash,
    and where one key's rows crowd a window, by their own number. The rows are written once and read for each step.
    Rows of equal key and cell are interchangeable; nulls are values; an empty table gives an empty one.
    """
    made = ["hilbert", "shard", "slot"]
    q = [f"_q{i}" for i in range(len(dims))]
    plain, names = hidden(docs)
    d = stored(docs.select(*docs.columns, *dims.values()).toDF(*plain.columns, *q).withColumn("_row", F.monotonically_increasing_id()), "sharding-rows")
    rows = d.count()
    d = quantised(d, q, settings).withColumn("_u", unit(names[key], seed=settings.seed))
    cells = hilbert(d.groupBy(*q).agg(F.count("*").alias("_n")), q, settings.bits, "_hilbert")
    # One row a cell, and at most 2 ** (bits x dimensions) of them, in buckets of neighbours on the curve.
    cells = cut(cells.withColumn("_buckets", F.ceil(F.col("_n") / settings.per_bucket)).drop("_n"))
    cells = cut(running(cells, [], ["_hilbert"], "_buckets", "_first", F.floor(F.col("_hilbert") / 4096), group=4096))
    d = d.join(small(cells, cells.count()), q).withColumn("_rows", F.lit(rows))
    place = F.col("_first") + F.floor(F.col("_u") * F.col("_buckets"))
    d = running(d.withColumn("_one", F.lit(1)), [], ["_u", names[key]], "_one", "_rank", place, group=4096, salt=unit("_row", seed=settings.seed), crowd=4 * settings.per_bucket)
    n = settings.shards
    d = d.withColumn("_shard", F.floor(F.col("_rank") * n / F.col("_rows")).cast("int"))
    # The quotient of doubles may fall short at a border; whole numbers decide.
    first = lambda s: F.expr(f"({s} * _rows + {n} - 1) div {n}")
    d = d.withColumn("_shard", F.when(F.col("_rank") >= first("(_shard + 1)"), F.col("_shard") + 1).when(F.col("_rank") < first("_shard"), F.col("_shard") - 1).otherwise(F.col("_shard")))
    return d.select(*shown(names, made), F.col("_hilbert").alias("hilbert"), F.col("_shard").alias("shard"), (F.col("_rank") - first("_shard")).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder a shard, its rows along the curve, so that files' minima and maxima of every dimension are narrow."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

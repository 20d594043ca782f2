"""Vectors in array columns: which of them count, samples, matrices and k-means."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut, small, stored, unit


def proper(vector: Column) -> Column:
    """Whether every component is a finite number and one isn't zero; false for null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def lengths(rows: DataFrame, vector: str = "v") -> list[int]:
    """The lengths that occur, in order."""
    return [r["d"] for r in rows.select(F.size(vector).alias("d")).distinct().orderBy("d").collect()]


def sample(rows: DataFrame, key: str, most: int, total: int, seed: int) -> DataFrame:
    """At most this many rows, the first by a hash of key."""
    u = unit(key, seed=seed)
    near = rows if total <= most else rows.filter(u < 1.25 * most / total)
    return near.withColumn("_u", u).orderBy("_u", key).limit(most).drop("_u")


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column, all of one length, as rows of doubles."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    if not sum(map(len, chunks)):
        return np.zeros((0, dim))
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks]).astype(np.float64).reshape(-1, dim)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows, summed in the components' order, so that equal rows have equal products."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to those of c."""
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """At most k distinct centres by Lloyd's algorithm from distinct rows; empty ones are left where they are."""
    first = np.unique(x, axis=0)
    centres = first[rng.permutation(len(first))[: min(k, len(first))]].copy()
    for _ in range(rounds):
        near = squares(x, centres).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


#: Vectors that a room's cells are fitted on, rows that meet a room's cells in one task, cells of a room at most.
_FITTED, _MET, _CELLS = 4096, 16_384, 256


def split(index: DataFrame, asked: DataFrame, on: list[str], key: str, dim: int, most: int, fitted: Callable, place: Callable, reach: Callable, seed: int, rounds: int = 5) -> tuple[DataFrame, DataFrame]:
    """index(*on, key, v, ...) and asked(*on, ...) with the rooms of index of more than most rows cut to cells, and these
    again, until none is larger or can be cut. on names a room; its last column is a long of 0 or more, which tells the cells apart.

    fitted(x, cells) makes a matrix of a row a cell from a bounded sample of a room's vectors; place(cells, x) is each
    vector's cell; reach(cells, rows) tells to which cells each asked row goes. So rooms stay of one size as rows grow
    in number, and an asked row is copied to the rooms that it reaches only. What is fitted stays in a table of one row a room.
    """
    room = on[-1]

    def fit(group: pa.Table) -> pa.Table:
        cells = fitted(matrix(group["v"], dim), int(min(_CELLS, max(2, -(-2 * group["rows"][0].as_py() // most)))))
        return group.select(on).slice(0, 1).append_column("k", pa.array([len(cells)], pa.int32())).append_column("cells", pa.array([cells.astype(np.float64).tobytes()], pa.binary()))

    def cut_up(rows: DataFrame, fits: DataFrame, by: Callable) -> DataFrame:
        """rows in the cells of their rooms, that by(cells, rows) gives as (which row, which cell); many rows of a room are dealt to several tasks."""
        turns = cut(rows.groupBy(*on).agg(F.ceil(F.count("*") / _MET).cast("int").alias("_turns")))
        turns = small(turns, turns.count())
        left = fits.join(turns, on).withColumn("_turn", F.explode(F.sequence(F.lit(0), F.col("_turns") - 1))).drop("_turns")
        right = rows.join(turns, on).withColumn("_turn", F.pmod(F.xxhash64(key, F.lit(seed)), F.col("_turns")).cast("int")).drop("_turns").select(*rows.columns, "_turn")

        def step(cells: pa.Table, table: pa.Table) -> pa.Table:
            table = table.drop_columns(["_turn"])
            if not cells.num_rows or not table.num_rows:
                return table.slice(0, 0)
            made = np.frombuffer(cells["cells"][0].as_py(), np.float64).reshape(cells["k"][0].as_py(), -1)
            row, cell = by(made, table)
            out = table.take(pa.array(row))
            of = out[room].to_numpy()
            named = -((2 * np.abs(of) + (of < 0)) * _CELLS + cell) - 1  # no other room, of this level or one above, has this number
            return out.set_column(out.schema.get_field_index(room), room, pa.array(named.astype(np.int64)))

        return left.groupBy(*on, "_turn").cogroup(right.groupBy(*on, "_turn")).applyInArrow(step, rows.schema)

    def placed(cells: np.ndarray, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(table.num_rows), place(cells, matrix(table["v"], dim))

    def reached(cells: np.ndarray, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(reach(cells, table))

    for level in range(rounds):
        sizes = cut(index.groupBy(*on).agg(F.count("*").alias("rows")).filter(F.col("rows") > most))
        if not sizes.head(1):
            break
        share = F.least(F.lit(1.0), F.lit(float(_FITTED)) / F.col("rows"))
        picked = index.join(small(sizes, sizes.count()), on).filter(unit(key, seed=seed + level) < share).select(*on, "rows", "v")
        fits = stored(picked.groupBy(*on).applyInArrow(fit, index.select(*on).withColumns({"k": F.lit(0), "cells": F.lit(b"")}).schema), "split-fits").filter("k > 1")
        known = fits.select(*on)
        if not known.head(1):
            break
        index, asked = (
            stored(rows.join(known, on, "left_anti").select(*rows.columns).union(cut_up(rows.join(known, on, "left_semi").select(*rows.columns), fits, by)), "split-rows")
            for rows, by in ((index, placed), (asked, reached))
        )
    return index, asked

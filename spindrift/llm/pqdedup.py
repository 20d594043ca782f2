"""Near-duplicate vectors by product quantisation: coarse lists, residual codes, table-lookup distances, exact cosine."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import BROADCAST_ROWS, components, small, stored
from spindrift.llm.vectors import dots, kmeans, lengths, matrix, proper, sample, split, squares


@dataclass(frozen=True)
class Settings:
    """cosine: from which two vectors link. sample: vectors on which the lists and codes are fitted, and never more than sample_bytes hold. lists: coarse ones, or
    one for per_list rows if that is more, as far as the sample gives each eight vectors. parts: subspaces of a residual, each with codes centres. block: rows that meet in one task."""

    cosine: float = 0.98
    sample: int = 16_384
    sample_bytes: int = 16 << 20
    lists: int = 64
    per_list: int = 512
    parts: int = 8
    codes: int = 256
    rounds: int = 8
    block: int = 2048
    seed: int = 37

    def sampled(self, dim: int) -> int:
        return max(1, min(self.sample, self.sample_bytes // (8 * dim)))


def reaches(x: np.ndarray, centres: np.ndarray, radius: float) -> np.ndarray:
    """Which cells may hold a vector within the radius of each vector: those that its ball reaches.

    A vector nearer to centre c than to c' lies on c's side of the plane between them, and the ball reaches that
    side only if the plane is no farther than the radius. That holds for vectors of any other cell above these, too.
    """
    d = squares(x, centres)
    own = d.argmin(1)
    between = np.sqrt(squares(centres, centres))[own]
    plane = (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * between, 1e-12)
    out = plane <= radius + 1e-6
    out[np.arange(len(x)), own] = True
    return out


@dataclass
class Quantiser:
    """Fitted on unit vectors. Distances are between unit vectors: cosine c is distance sqrt(2 - 2 c)."""

    centres: np.ndarray
    books: list[np.ndarray]
    cuts: list[int]
    radius: float

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, a:b] for a, b in zip(self.cuts, self.cuts[1:], strict=False)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, error, constant) of unit vectors: error is the distance to what list and codes stand for;
        constant is the part of a table-lookup distance that doesn't depend on the query."""
        near = squares(x, self.centres).argmin(1)
        rest = x - self.centres[near]
        codes = np.stack([squares(r, b).argmin(1) for r, b in zip(self.parts(rest), self.books, strict=True)], axis=1).astype(np.uint8)
        made = np.hstack([b[codes[:, m]] for m, b in enumerate(self.books)])
        return near.astype(np.int32), codes, np.sqrt(((rest - made) ** 2).sum(1)), (made * made).sum(1) + 2 * (self.centres[near] * made).sum(1)

    def probes(self, x: np.ndarray) -> np.ndarray:
        return reaches(x, self.centres, self.radius)

    def distances(self, x: np.ndarray, near: np.ndarray, codes: np.ndarray, constant: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances of unit vectors to coded ones, by table lookup."""
        out = squares(x, self.centres)[:, near] + constant[None]
        for m, (q, b) in enumerate(zip(self.parts(x), self.books, strict=True)):
            out -= np.take((2 * q @ b.T), codes[:, m], axis=1)
        return out


def fit(x: np.ndarray, settings: Settings, rows: int = 0) -> Quantiser:
    rng = np.random.default_rng(settings.seed)
    centres = kmeans(x, max(1, min(max(settings.lists, rows // settings.per_list), len(x) // 8)), settings.rounds, rng)
    rest = x - centres[squares(x, centres).argmin(1)]
    parts = min(settings.parts, x.shape[1])
    cuts = [x.shape[1] * i // parts for i in range(parts + 1)]
    books = [kmeans(rest[:, a:b], settings.codes, settings.rounds, rng) for a, b in zip(cuts, cuts[1:], strict=False)]
    return Quantiser(centres, books, cuts, math.sqrt(max(0.0, 2 - 2 * settings.cosine)))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # else squares of very large or small components leave the doubles' range
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return dots(a, b) / np.sqrt(dots(a, a) * dots(b, b))


def _sets(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that the pairs (a, b) lead each of n nodes to."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def grouped(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()) -> DataFrame:
    """(key, n_links, component_id, kept) for each row; only vectors of equal labels and lengths link, and none of a null label.

    Equal vectors of a label are one class, so that copies aren't compared. Every class is coded; a class looks into each
    list whose cell its ball of the radius reaches, keeps what the table-lookup distance less the coding error doesn't
    put outside, and takes the exact cosine of the vectors themselves in double precision. Neither step can lose a
    link, whatever the sample. Lists of a label lie together in blocks; one of many rows is cut to lists of its own, so
    that blocks stay of one size as rows grow in number. A block gives each class its number of links, and one edge a class; never the pairs. Vectors of several lengths are
    made as long as the next power of two by zeros, which change no cosine, and there is a quantiser for each of these.

    Vectors that are null, zero or of null or non-finite components link with nothing, and form a component of their
    own. n_links counts rows, so copies count; rows of equal key are rows of their own. A null key is never the
    smallest; kept is false for it. No rows: no rows.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).cast("string").alias("label"))
    rows = rows.withColumn("v", F.when(proper(F.col("v")), F.col("v"))).withColumn("label", F.concat(F.size("v").cast("string"), F.lit(":"), "label"))
    good = rows.filter("v IS NOT NULL AND label IS NOT NULL")
    classes = stored(good.groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n")).withColumn("c", F.monotonically_increasing_id()), "pq-classes")
    found = None
    for dim in sorted({1 << (d - 1).bit_length() for d in lengths(classes)}):
        own = classes.filter((F.size("v") <= dim) & (F.size("v") > dim // 2))
        part = _links(own.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("v")))), dim, settings)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    joined = components(found.filter("c <> root").select(F.col("c").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("c").alias("_c")).agg(F.sum("links").alias("links"))
    full = classes.join(joined, classes["c"] == joined["node"], "left").join(links, F.col("c") == F.col("_c"), "left")
    full = full.select("label", "v", "least", "n", F.coalesce("component", "c").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), F.col("component").isNotNull().alias("linked"))
    least = full.filter("linked").groupBy("root").agg(F.min("least").alias("first"))
    # A single row without links needs no join.
    wide = full.filter("linked").join(least, "root").select("label", "v", "links", "n", "first").union(full.filter("NOT linked AND n > 1").select("label", "v", "links", "n", F.col("least").alias("first")))
    wide = stored(wide, "pq-wide").select(F.col("label").alias("_label"), F.col("v").alias("_v"), "links", "n", "first")
    done = rows.join(wide, (rows["label"] == wide["_label"]) & (rows["v"] == wide["_v"]), "left")
    done = done.select("id", F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"))
    return done.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _links(classes: DataFrame, dim: int, settings: Settings) -> DataFrame:
    """(c, links, root) of classes(c, label, v, n) with vectors of one length: links are rows, and root is a class that c's links lead to."""
    spark = classes.sparkSession
    total = classes.count()
    picked = sample(classes.select("c", "v"), "c", settings.sampled(dim), total, settings.seed).toArrow()
    held = spark.sparkContext.broadcast(fit(_unit(matrix(picked["v"], dim)), settings, total))
    rooms = classes.groupBy("label").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("rooms"))
    rooms = stored(rooms, "pq-labels")
    withroom = classes.join(small(rooms, rooms.count()), "label")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser = held.value
        lists = len(quantiser.centres)
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                x, rooms = _unit(matrix(b.column(3), dim)), b.column(4).to_numpy().astype(np.int64)
                near, codes, error, constant = quantiser.encode(x)
                room = near.astype(np.int64) * np.minimum(rooms, lists) // lists
                reach = quantiser.probes(x)
                to = [np.unique(np.flatnonzero(r) * min(k, lists) // lists).tolist() for r, k in zip(reach, rooms.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(near), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(constant), pa.array(room), pa.array(to, pa.list_(pa.int64()))], names=["label", "c", "n", "v", "list", "codes", "error", "constant", "room", "to"])

    coded = stored(withroom.select("label", "c", "n", "v", "rooms").mapInArrow(code, "label string, c long, n long, v array<double>, list int, codes binary, error double, constant double, room long, to array<long>"), "pq-codes")
    index, asked = coded.drop("to"), coded.select("label", "c", "v", F.explode("to").alias("room"))
    radius = math.sqrt(max(0.0, 2 - 2 * settings.cosine))

    def cells(x: np.ndarray, k: int) -> np.ndarray:
        return kmeans(_unit(x), k, settings.rounds, np.random.default_rng(settings.seed))

    # Lists of more rows than a block are cut to lists of their own, as often as it takes.
    index, asked = split(index, asked, ["label", "room"], "c", dim, settings.block, cells, lambda c, x: squares(_unit(x), c).argmin(1), lambda c, rows: reaches(_unit(matrix(rows["v"], dim)), c, radius), settings.seed)
    parts = stored(index.groupBy("label", "room").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts")), "pq-blocks")
    parts = small(parts, parts.count(), BROADCAST_ROWS)
    index = index.join(parts, ["label", "room"]).withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int")).select("label", "room", "part", "c", "n", "v", "list", "codes", "error", "constant")
    asked = asked.join(parts, ["label", "room"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # As a block's rows are bounded, what asks it is dealt to several tasks too, each with a copy of the block.
    turns = stored(asked.groupBy("label", "room", "part").agg(F.ceil(F.count("*") / (4 * settings.block)).cast("int").alias("turns")), "pq-turns")
    turns = small(turns, turns.count(), BROADCAST_ROWS)
    on = ["label", "room", "part"]
    index = index.join(turns, on).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
    asked = asked.join(turns, on).withColumn("turn", F.pmod(F.xxhash64("c", F.lit(1)), F.col("turns")).cast("int")).select(*[F.col(c).alias(c) for c in (*on, "turn", "c", "v")])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        quantiser = held.value
        vy, vx, cy, cx = matrix(left["v"], dim), matrix(right["v"], dim), left["c"].to_numpy(), right["c"].to_numpy()
        out = [np.empty(0, np.int64)] * 3
        if len(cy) and len(cx):
            near, error, constant, n = (left[c].to_numpy() for c in ("list", "error", "constant", "n"))
            codes = np.frombuffer(b"".join(left["codes"].to_pylist()), np.uint8).reshape(len(cy), -1)
            pairs = []
            for at in range(0, len(cx), 256):
                x = _unit(vx[at : at + 256])
                far = np.sqrt(np.maximum(quantiser.distances(x, near, codes, constant), 0))
                i, j = np.nonzero((far <= quantiser.radius + error[None] + 1e-6) & quantiser.probes(x)[:, near])
                i = i + at
                real = cx[i] != cy[j]
                i, j = i[real], j[real]
                for a in range(0, len(i), 1 << 16):
                    close = cosines(vx[i[a : a + (1 << 16)]], vy[j[a : a + (1 << 16)]]) >= settings.cosine
                    pairs.append((i[a : a + (1 << 16)][close], j[a : a + (1 << 16)][close]))
            i, j = (np.concatenate([p[c] for p in pairs]) if pairs else np.empty(0, np.int64) for c in (0, 1))
            if len(i):
                every, where = np.unique(np.concatenate([cx[i], cy[j]]), return_inverse=True)
                root = every[_sets(len(every), where[: len(i)], where[len(i) :])]
                links = np.zeros(len(every), np.int64)
                np.add.at(links, where[: len(i)], n[j])
                out = [every, links, root]
        return pa.table([pa.array(o) for o in out], names=["c", "links", "root"])

    block = [*on, "turn"]
    return stored(index.groupBy(*block).cogroup(asked.groupBy(*block)).applyInArrow(meet, "c long, links long, root long"), "pq-links")

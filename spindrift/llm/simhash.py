"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into so few segments that, of two within the distance, one segment differs by one bit at most.
Each segment is indexed once for each of its bits with that bit left out; two such segments meet under an equal key.

Fingerprints so near are of texts that are nearly equal. Texts whose sets of shingles have a similarity of 0.8 differ in
some ten bits, where neither few segments nor keys of few bits tell them from strangers; so resembling() takes the pairs
of the same variants, adds to them those that bands of least digests of the shingles find farther apart, of which it
sorts out strangers by SimHash, and verifies all of them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import bucketed, components, cut, hidden, passing, release, short_batches, shown, small, stored

BITS = 64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Settings:
    """shingle: words in a shingle. distance: differing bits up to which two fingerprints link. seed: of XXH64.
    tables: fingerprints of a text, each from other bits of the same digests; texts link if they do in any of them.
    group: fingerprints under one key that are compared in one task; larger groups are split further by more bits,
    which ends as a key of enough bits leaves fewer than this many fingerprints (2048 at the most)."""

    shingle: int = 3
    distance: int = 3
    seed: int = 42
    tables: int = 1
    group: int = 4096


def _mixed(h: np.ndarray, table: int) -> np.ndarray:
    """The digests themselves for table 0, else other 64 bits made of them (the finaliser of splitmix64)."""
    if not table:
        return h
    z = h + np.uint64(table * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = (np.arange(8, dtype=np.int64) * 256)[None, :]


def _shingles(text: str | None, k: int) -> tuple[bytes, np.ndarray, np.ndarray, int]:
    """The text's words joined by spaces, where its shingles of k words (of all, if it has fewer) start and end there, and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []  # bytes.split() cuts at ASCII white space
    if not words:
        return b"", np.empty(0, np.int64), np.empty(0, np.int64), 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts, k = np.concatenate(([0], ends[:-1] + 1)), min(k, len(words))
    n = len(words) - k + 1
    return b" ".join(words), starts[:n], ends[k - 1 :], n


def _digests(joined: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[x:y], seed) for x, y in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


def _count(counts: np.ndarray, h: np.ndarray) -> None:
    """Adds how often each byte stands at each place of a digest, which gives each bit's count."""
    for t in range(len(counts)):
        counts[t] += np.bincount((_mixed(h, t).view(np.uint8).reshape(-1, 8) + _PLACES).ravel(), minlength=2048).reshape(8, 256)


def _majority(counts: np.ndarray, n: int) -> list[int]:
    ones = (counts @ _BYTE_BITS).reshape(len(counts), BITS)
    return [int.from_bytes(np.packbits(2 * x > n, bitorder="little").tobytes(), "little") for x in ones]


def fingerprint(text: str | None, settings: Settings = Settings()) -> list[int]:
    """The SimHashes of a whole text's word shingles, repeats included, one for each table; 0 for a text without words and for null."""
    joined, starts, ends, n = _shingles(text, settings.shingle)
    if not n:
        return [0] * settings.tables
    counts = np.zeros((settings.tables, 8, 256), np.int64)
    step = 1 << 16
    for at in range(0, n, step):
        _count(counts, _digests(joined, starts[at : at + step], ends[at : at + step], settings.seed))
    return _majority(counts, n)


def fingerprints(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs without the text, with fps, an array of signed longs, last (columns of that name are replaced); a narrow transformation."""
    kept = docs.drop("fps") if text != "fps" else docs
    schema = kept.drop(text).withColumn("fps", F.array(F.lit(0).cast("long"))).schema
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t, settings) for t in b.column(at).to_pylist()], np.uint64).reshape(-1, settings.tables).view(np.int64)
            rest = [c for i, c in enumerate(b.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(list(found), pa.list_(pa.int64()))], names=schema.names)

    return kept.mapInArrow(run, schema)


#: A key is (wild, masked): wild holds table and left-out bit of each level, nine bits a level from the lowest up, each plus one.
_LEVEL = 9


@lru_cache(maxsize=100_000)
def variants(wild: int, distance: int) -> tuple[tuple[int, int], ...]:
    """For the key that has left out the bits in wild, each (key, mask) of the next level: the bit that it leaves out
    besides, and the mask of all bits that it then holds."""
    segments, left, held, level = distance // 2 + 1, list(range(BITS)), 0, 0
    table = ((wild & 511) - 1) // BITS if wild else 0
    while wild >> level * _LEVEL:
        bit = ((wild >> level * _LEVEL & 511) - 1) % BITS
        segment = next(s for s in _cut(left, segments) if bit in s)
        held |= sum(1 << b for b in segment if b != bit)
        left = [b for b in left if b not in segment]
        level += 1
    return tuple((wild | (table * BITS + b + 1) << level * _LEVEL, held | sum(1 << c for c in s if c != b)) for s in _cut(left, segments) for b in s)


def _cut(bits: list[int], n: int) -> list[list[int]]:
    edges = [len(bits) * i // n for i in range(n + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:], strict=False) if b > a]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked(ids: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join each linked set of a group: from every member to the set's first."""
    n, label = len(fps), np.arange(len(fps))
    left, right = [], []
    for at in range(0, n, 512):
        a, b = np.nonzero(np.bitwise_count(fps[at : at + 512, None] ^ fps[None, at:]) <= distance)
        keep = b > a
        left.append(a[keep] + at)
        right.append(b[keep] + at)
    a, b = np.concatenate(left), np.concatenate(right)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return ids[moved], ids[label[moved]]


_KEYED = "wild long, masked long, id long, fp long"
_FOUND = "wild long, a long, b long, fp long"


def _compare(settings: Settings):
    """Over rows (wild, masked, id, fp) sorted by key: edges (a, b), and the members a of too large groups with b null."""

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(a), pa.array(b), none], names=["wild", "a", "b", "fp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, size, over = None, [], 0, False  # the group that is open at a batch's end
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> None:
            if size > 1 and not over:
                out.append(_linked(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), settings.distance))

        for batch in batches:
            if not batch.num_rows:
                continue
            w, masked, ids, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            fp = fp.astype(np.int64).view(np.uint64)
            bounds = np.concatenate(([0], np.flatnonzero((masked[1:] != masked[:-1]) | (w[1:] != w[:-1])) + 1, [len(fp)]))
            sizes = np.diff(bounds)
            inner = np.zeros(len(sizes), bool)
            inner[1:-1] = True  # the first and the last group may go on in other batches
            at = bounds[:-1][inner & (sizes == 2)]
            near = at[np.bitwise_count(fp[at] ^ fp[at + 1]) <= settings.distance]
            out.append((ids[near], ids[near + 1]))
            for i in np.flatnonzero(~inner | (sizes > 2)).tolist():
                lo, hi = int(bounds[i]), int(bounds[i + 1])
                this = (int(w[lo]), int(masked[lo]))
                if this != key:
                    close()
                    key, parts, size, over = this, [], 0, False
                parts.append((ids[lo:hi].copy(), fp[lo:hi].copy()))
                size += hi - lo
                if size > settings.group:
                    over = True
                    for i_, f_ in parts:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i_), key[0])), pa.array(i_), pa.nulls(len(i_), pa.int64()), pa.array(f_.view(np.int64))], names=["wild", "a", "b", "fp"])
                    parts = []
            for a, b in out:
                if len(a):
                    yield edges(a, b)
            out = []
        close()
        for a, b in out:
            if len(a):
                yield edges(a, b)

    return run


def _deeper(settings: Settings):
    """Members of too large groups under the keys of the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, ids, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.astype(np.int64).view(np.uint64)
            for wild in np.unique(w).tolist():
                own, of = fp[w == wild], ids[w == wild]
                for key, mask in variants(wild, settings.distance):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), key)), pa.array((own & np.uint64(mask)).view(np.int64)), pa.array(of), pa.array(own.view(np.int64))], names=["wild", "masked", "id", "fp"])

    return run


def links(nodes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Edges (a, b) of ids whose components are those of all linked pairs of nodes(id, fps), which must differ in fps.

    Of the nodes that share a fingerprint of a table only one is compared there, so a group is of different fingerprints. Each key's group yields a link a member at most, never its pairs.
    """
    keys = [[(t * BITS + wild, mask) for wild, mask in variants(0, settings.distance)] for t in range(settings.tables)]
    table = [F.array(*[F.array(*[F.lit(k[i] if not i else _signed(k[i])).cast("long") for k in of]) for of in keys]) for i in (0, 1)]
    # Nodes that share a fingerprint of a table stand for each other there: but for one, each has a link to that one only.
    if settings.tables > 1:
        each = nodes.select("id", F.posexplode("fps").alias("t", "fp"))
        lowest = stored(each.groupBy("t", "fp").agg(F.min("id").alias("id"), F.count("*").alias("m")), "simhash-lowest")
        shared = lowest.filter("m > 1").select("t", "fp", F.col("id").alias("b"))
        out = cut(each.join(shared, ["t", "fp"]).select(F.col("id").alias("a"), "b").filter("a <> b").distinct())
    else:
        lowest, out = nodes.select("id", F.lit(0).alias("t"), F.col("fps")[0].alias("fp")), None
    keyed = lowest.select("id", "t", "fp", F.explode(F.sequence(F.lit(0), F.lit(len(keys[0]) - 1))).alias("i"))
    keyed = keyed.select("id", "fp", *[F.get(F.get(x, F.col("t")), F.col("i")).alias(n) for x, n in zip(table, ("wild", "mask"), strict=True)])
    keyed = keyed.select("wild", F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "id", "fp")
    while True:
        dealt = keyed.repartition(F.col("wild"), F.col("masked")).sortWithinPartitions("wild", "masked").mapInArrow(_compare(settings), _FOUND)
        found = stored(dealt, "simhash-links")
        edges = found.filter("b IS NOT NULL").select("a", "b")
        out = edges if out is None else out.union(edges)
        large = found.filter("b IS NULL")
        if not large.head(1):
            return out.distinct()
        keyed = large.select("wild", F.col("a").alias("id"), "fp").mapInArrow(_deeper(settings), _KEYED)


def _first(rows: DataFrame, least: Column, settings: Settings) -> DataFrame:
    """(_fps, first) of rows(fps, ...) in groups of several rows: first is the group's smallest value of least."""
    nodes = stored(rows.groupBy("fps").agg(F.min(least).alias("least"), F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()), "simhash-nodes")
    edges = links(nodes.select("id", "fps"), settings)
    return _lowest(nodes, "fps", edges).withColumnRenamed("fps", "_fps")


def _lowest(nodes: DataFrame, by: str, edges: DataFrame) -> DataFrame:
    """(by, first) of nodes(id, by, least, n) that are linked or of several rows: first is the smallest least of the node's component."""
    joined = components(edges)
    root = nodes.join(joined, nodes["id"] == joined["node"], "left").select(by, "least", "n", F.coalesce("component", "id").alias("root"), F.col("component").isNotNull().alias("linked"))
    lowest = root.filter("linked").groupBy("root").agg(F.min("least").alias("first"))
    return root.filter("linked").join(lowest, "root").select(by, "first").union(root.filter("NOT linked AND n > 1").select(by, F.col("least").alias("first")))


def grouped(docs: DataFrame, text: str = "text", key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """(key, fps, component_id) for each row: component_id is the smallest key that links reach, itself included.

    Rows of equal fingerprints are one node; nulls in text count as no words; a null key is never the smallest, and
    where no key is left component_id is null. Repeated rows stay; an empty table gives an empty one.
    """
    rows = stored(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", settings), "simhash-prints", 1000)
    wide = _first(rows, F.col("key"), settings)
    # A single row without links keeps its own key; only the others meet in the join.
    return rows.join(wide, rows["fps"] == wide["_fps"], "left").select(F.col("key").alias(key), "fps", F.when(F.col("_fps").isNull(), F.col("key")).otherwise(F.col("first")).alias("component_id"))


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", settings: Settings = Settings(shingle=5)) -> DataFrame:
    """The rows of docs of which none of the same group stands before them: by key, null last, then as they were read.

    So one row of each group stays, of repeated rows too. Texts without words are a group.
    """
    plain, names = hidden(docs)
    key = names[key]
    with short_batches(docs.sparkSession):
        rows = bucketed(fingerprints(plain.withColumn("_text", F.col(names[text])), "_text", settings).withColumn("_row", F.monotonically_increasing_id()), "simhash-rows", "_row")
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("row"))
    slim = rows.select(key, "_row", "fps")
    wide = _first(slim, rank, settings)
    gone = cut(slim.join(wide, slim["fps"] == wide["_fps"]).filter(~rank.eqNullSafe(F.col("first"))).select(F.col("_row").alias("_gone")))
    return rows.join(gone.hint("shuffle_hash"), rows["_row"] == F.col("_gone"), "left_anti").select(*shown(names))


@dataclass(frozen=True)
class Resemblance:
    """shingle: words in a shingle. similarity: Jaccard similarity of two texts' sets of shingles from which they link.
    seed: of XXH64. bits: two texts meet, by deletion variants, if so many bits of their sets' SimHashes differ at most.
    bands, rows: they meet besides if in one of so many bands all of so many permutations of the digests
    have the same least one in both sets. distance: of those that meet so, they are compared exactly if this many bits of
    their sets' SimHashes differ at most. group: rows of one key that are looked at in one task; more are dealt.

    At similarity 0.8 a band is alike with 0.8 ** 7 = 0.21, and one of 20 with 0.991 (at 0.85 with 0.9996); of texts that
    share a tenth, one pair in 500,000 meets. At 0.8 a bit differs with probability acos(8 / 9) / pi = 0.151, so distance is
    four standard deviations above the mean of 9.7."""

    shingle: int = 5
    similarity: float = 0.8
    seed: int = 42
    bits: int = 3
    bands: int = 20
    rows: int = 7
    distance: int = 21
    group: int = 1 << 16


#: Of groups up to _FEW nodes all pairs are looked at together; _DENSE pairs a node make a group one of near copies.
_FEW, _DENSE = 64, 4
_ROWS = 1 << 18
_PAIRS = "wild long, a long, b long, fp long"
#: Pairs of one text that are verified in one task, about, and that go to Python at once.
_SHARE, _BATCH = 256, 100


def shingle_set(text: str | None, settings: Resemblance = Resemblance()) -> np.ndarray:
    """The digests of a whole text's different shingles, in order."""
    joined, starts, ends, _ = _shingles(text, settings.shingle)
    return np.unique(_digests(joined, starts, ends, settings.seed))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets in order; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


@lru_cache(maxsize=8)
def _odd(settings: Resemblance) -> np.ndarray:
    return np.random.default_rng(settings.seed).integers(0, 1 << 63, settings.bands * settings.rows, np.uint64) * np.uint64(2) + np.uint64(1)


def bands(h: np.ndarray, settings: Resemblance = Resemblance()) -> np.ndarray:
    """A key for each band of a set of digests; none for an empty set. The permutations are products with drawn odd numbers."""
    if not len(h):
        return np.empty(0, np.int64)
    odd = _odd(settings)
    least = np.full(len(odd), ~np.uint64(0))
    for at in range(0, len(h), 512):
        np.minimum(least, (h[at : at + 512, None] * odd[None]).min(axis=0), out=least)
    return np.array([xxhash.xxh3_64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(settings.bands, settings.rows))], np.uint64).view(np.int64)


def sketches(docs: DataFrame, text: str, settings: Resemblance) -> DataFrame:
    """docs without the text, with _set, a digest of 128 bits of its shingles' set, fp, the set's SimHash, and keys, its bands."""
    kept = docs.drop(text)
    schema = kept.withColumns({"_set": F.lit(b""), "fp": F.lit(0).cast("long"), "keys": F.array(F.lit(0).cast("long"))}).schema
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, prints, keys = [], np.zeros(b.num_rows, np.uint64), []
            for i, t in enumerate(b.column(at)):
                h = shingle_set(t.as_py(), settings)
                counts = np.zeros((1, 8, 256), np.int64)
                _count(counts, h)
                names.append(xxhash.xxh3_128_digest(h.tobytes()))
                prints[i] = _majority(counts, len(h))[0]
                keys.append(bands(h, settings))
            rest = [c for i, c in enumerate(b.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(names, pa.binary()), pa.array(prints.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], names=schema.names)
        release()

    return docs.mapInArrow(run, schema)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of batches sorted by the first, many rows at a time, with whole groups of it."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)])
        rows += b.num_rows
        if rows >= _ROWS and held[0][0][0] != held[-1][0][-1]:
            joined = [np.concatenate(c) for c in zip(*held, strict=True)]
            at = int(np.searchsorted(joined[0], joined[0][-1]))
            yield [c[:at] for c in joined]
            held = [[c[at:].copy() for c in joined]]
            rows = len(held[0][0])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _pair_batch(a: np.ndarray, b: np.ndarray | None, wild: np.ndarray | None = None, fp: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    low, high = (a, None) if b is None else (np.minimum(a, b), np.maximum(a, b))
    return pa.RecordBatch.from_arrays([none if wild is None else pa.array(wild), pa.array(low), none if high is None else pa.array(high), none if fp is None else pa.array(fp)], names=["wild", "a", "b", "fp"])


def _met(wild: np.ndarray, ids: np.ndarray, signed: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """Of rows (wild, id, fp) sorted by wild: pairs (a, b) of a group within the distance. Of a group of near copies, or
    of many nodes, only a link a node to one that leads it, and the members with b null, for _cross."""

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count(x ^ y) <= distance

    bounds = np.concatenate(([0], np.flatnonzero(wild[1:] != wild[:-1]) + 1, [len(wild)]))
    size = np.diff(bounds)
    group, fp = np.repeat(np.arange(len(size)), size), signed.view(np.uint64)
    rows = np.flatnonzero((size[group] > 1) & (size[group] <= _FEW))
    found = [np.empty((2, 0), np.int64)]
    for step in range(1, _FEW):
        rows = rows[rows + step < bounds[group[rows] + 1]]
        if not len(rows):
            break
        kept = rows[near(fp[rows], fp[rows + step])]
        found.append(np.stack([kept, kept + step]))
    a, b = np.concatenate(found, axis=1)
    many = (np.bincount(group[a], minlength=len(size)) > _DENSE * size) | (size > _FEW)
    plain = ~many[group[a]]
    yield _pair_batch(ids[a[plain]], ids[b[plain]])
    for g in np.flatnonzero(many).tolist():
        lo, hi = int(bounds[g]), int(bounds[g + 1])
        left = lo + np.argsort(ids[lo:hi])
        for _ in range(_FEW):
            alike = near(fp[left], fp[left[0]])
            own = left[alike][1:]
            yield _pair_batch(ids[own], np.full(len(own), ids[left[0]]))
            left = left[~alike]
            if len(left) < 2:
                break
        yield _pair_batch(ids[lo:hi], None, wild[lo:hi], signed[lo:hi])


def _meet(settings: Resemblance):
    """Over rows (wild, id, fp) sorted by wild, the keys of bands or variants: what _met() finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole(batches):
            yield from _met(*rows, settings.distance)

    return run


def halves(bits: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each half of each segment its mask, and those of variants(), as (wild, mask), that leave out a bit of the
    segment's other half: what such a variant holds tells the half, so all that share it have one key by the half."""
    found = []
    for segment in _cut(list(range(BITS)), bits // 2 + 1):
        first, second = _cut(segment, 2)
        found += [(sum(1 << b for b in own), [v for v in variants(0, bits) if v[0] - 1 in other]) for own, other in ((first, second), (second, first))]
    return found


def _meet_variants(settings: Resemblance):
    """Over rows (wild, id, fp, half) sorted by wild, a key by the half: what _met() finds under each of its variants."""
    parts = halves(settings.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, signed, half in _whole(batches):
            for h in np.unique(half).tolist():
                of, fps = ids[half == h], signed[half == h]
                for wild, mask in parts[h][1]:
                    keys = _mixed(fps.view(np.uint64) & np.uint64(mask), wild).view(np.int64)
                    order = np.argsort(keys)
                    keys = keys[order]
                    again = keys[1:] == keys[:-1]
                    shared = np.concatenate((again, [False])) | np.concatenate(([False], again))
                    order, keys = order[shared], keys[shared]
                    if len(keys):
                        yield from _met(keys, of[order], fps[order], settings.bits)

    return run


def _cross(settings: Resemblance):
    """Over rows (wild, id, fp, component) sorted by wild: all pairs within the distance that aren't in one component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wild, ids, signed, component in _whole(batches):
            bounds = np.concatenate(([0], np.flatnonzero(wild[1:] != wild[:-1]) + 1, [len(wild)]))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                i, f = ids[lo:hi], signed[lo:hi].view(np.uint64)
                names, c, n = np.unique(component[lo:hi], return_inverse=True, return_counts=True)
                if len(names) < 2:
                    continue
                rank = np.argsort(np.argsort(n, kind="stable"))[c]  # the largest component's nodes need no search of their own
                order = np.argsort(rank, kind="stable")
                i, f, rank = i[order], f[order], rank[order]
                for at in range(int(np.searchsorted(rank, len(names) - 1))):
                    first = int(np.searchsorted(rank, rank[at], "right"))
                    b = first + np.flatnonzero(np.bitwise_count(f[first:] ^ f[at]) <= settings.distance)
                    if len(b):
                        yield _pair_batch(np.full(len(b), i[at]), i[b])

    return run


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, settings: Resemblance) -> DataFrame:
    """Those of pairs(a, b) of nodes(id, row, ...) whose texts(_row, _text) have shingles of the similarity.

    texts stay where they are, if they are in buckets by _row: pairs come to the texts of b, which go on to a's. A text that
    is a of many pairs goes to several tasks, which share its pairs.
    """
    near = pairs.join(nodes.select(F.col("id").alias("a"), F.col("row").alias("ra")), "a")
    near = stored(near.join(nodes.select(F.col("id").alias("b"), F.col("row").alias("rb")), "b").select("a", "b", "ra", "rb"), "simhash-near")
    leads = cut(near.groupBy("ra").agg(F.ceil(F.count("*") / _SHARE).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("rb"), F.col("parts")).cast("int")
    near = near.join(leads, "ra").select("a", "b", "rb", F.col("ra").alias("lead"), part.alias("part"))
    lead = texts.join(leads.hint("shuffle_hash"), texts["_row"] == leads["ra"]).select(F.col("ra").alias("lead"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("_text").alias("ta"))
    follow = texts.join(near.hint("shuffle_hash"), texts["_row"] == near["rb"]).select("lead", "part", "a", "b", F.col("_text").alias("tb"))
    both = follow.join(lead.hint("merge"), ["lead", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                sets = []
                for id_, text in ((batch.column(0)[i].as_py(), 2), (batch.column(1)[i].as_py(), 3)):
                    if id_ not in known:
                        if len(known) >= 100:
                            known.pop(next(iter(known)))
                        known[id_] = shingle_set(batch.column(text)[i].as_py(), settings)
                    sets.append(known[id_])
                if jaccard(*sets) >= settings.similarity:
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))
        known.clear()
        release()

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _nth(i: Column, of: list[Column]) -> Column:
    out = of[0]
    for k, value in enumerate(of[1:], 1):
        out = F.when(i == k, value).otherwise(out)
    return out


def resembling(nodes: DataFrame, texts: DataFrame, settings: Resemblance = Resemblance()) -> DataFrame:
    """Edges (a, b) between nodes(id, fp, keys, row), different sets of shingles, of at least the similarity.

    Two meet by the variants of their fingerprints, as in links(), or by a band. A variant isn't shuffled by itself: nodes
    are by the half of the segment that it holds whole, and have their variants made there.
    The edges' components are those of all pairs that meet under a key: in groups of near copies first only the links to
    leading nodes are verified, and then all pairs that these have left in different components. A key of more rows than
    a task may hold is dealt to several groups, whose members are besides compared with the key's first node.
    """
    parts = halves(settings.bits)
    half = F.explode(F.array(*[F.struct(F.lit(i).alias("half"), F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(mask)))).alias("wild")) for i, (mask, _) in enumerate(parts)]))
    halved = nodes.select("id", "fp", half.alias("h")).select("h.wild", "id", "fp", "h.half")
    keyed = nodes.select(F.explode("keys").alias("wild"), "id", "fp")
    # A half that very many share is no key to deal by: its nodes are dealt by their variants themselves.
    common = cut(halved.groupBy("wild").agg(F.count("*").alias("n")).filter(F.col("n") > settings.group).select("wild"))
    if n := common.count():
        each = [F.array(*[F.xxhash64(F.lit(wild), F.col("fp").bitwiseAND(F.lit(_signed(mask)))) for wild, mask in own]) for _, own in parts]
        keyed = keyed.union(halved.join(small(common, n), "wild", "left_semi").select(F.explode(_nth(F.col("half"), each)).alias("wild"), "id", "fp"))
        halved = halved.join(small(common, n), "wild", "left_anti")
    keyed = stored(keyed, "simhash-keys")
    crowded = cut(keyed.groupBy("wild").agg(F.count("*").alias("n"), F.min(F.struct("id", "fp")).alias("lead")).filter(F.col("n") > settings.group))
    crowded = crowded.select("wild", "lead", F.ceil(F.col("n") * 2 / settings.group).cast("int").alias("parts"))
    hot = crowded.count()
    plain, lead = keyed, None
    if hot:
        members = keyed.join(small(crowded, hot), "wild").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        alike = F.bit_count(F.col("fp").bitwiseXOR(F.col("lead.fp"))) <= settings.distance
        lead = members.filter(alike & (F.col("id") > F.col("lead.id"))).select(F.col("lead.id").alias("a"), F.col("id").alias("b"))
        plain = keyed.join(small(crowded, hot), "wild", "left_anti").union(members.select(F.xxhash64("wild", "part"), "id", "fp"))
    varied = halved.repartition("wild").sortWithinPartitions("wild").mapInArrow(_meet_variants(settings), _PAIRS)
    found = stored(varied.union(plain.repartition("wild").sortWithinPartitions("wild").mapInArrow(_meet(settings), _PAIRS)), "simhash-pairs")
    first = found.filter("b IS NOT NULL").select("a", "b")
    tested = stored((first.union(lead) if hot else first).distinct(), "simhash-tested")
    edges = stored(_verified(tested, nodes, texts, settings), "simhash-edges", _BATCH)
    many = found.filter("b IS NULL").select("wild", F.col("a").alias("id"), "fp")
    if not many.head(1) and not hot:
        return edges
    joined = components(edges)

    def told(rows: DataFrame) -> DataFrame:
        return rows.join(joined, rows["id"] == joined["node"], "left").withColumn("component", F.coalesce("component", "id")).drop("node")

    many = told(many).select("wild", "id", "fp", "component")
    split = many.groupBy("wild").agg((F.min("component") < F.max("component")).alias("split")).filter("split").select("wild")
    rest = many.join(split, "wild", "left_semi").repartition("wild").sortWithinPartitions("wild").mapInArrow(_cross(settings), _PAIRS).select("a", "b")
    if hot:
        rest = rest.union(_across(told(members.select("wild", "part", "parts", "id", "fp")), settings))
    rest = rest.distinct().join(tested, ["a", "b"], "left_anti")
    return edges.union(stored(_verified(stored(rest, "simhash-rest"), nodes, texts, settings), "simhash-edges", _BATCH))


def _across(members: DataFrame, settings: Resemblance) -> DataFrame:
    """Pairs (a, b) within the distance of members(wild, part, parts, id, fp, component) of one wild and different
    components. One of two is outside of the key's largest component; those go to every part of their key, in batches."""
    members = stored(members, "simhash-members")
    largest = members.groupBy("wild", "component").agg(F.count("*").alias("n")).groupBy("wild").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    outside = stored(members.join(small(largest, largest.count()), "wild").filter("component <> largest").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), "simhash-outside")
    turns = cut(outside.groupBy("wild", "part").agg(F.ceil(F.count("*") / settings.group).cast("int").alias("turns")))
    turns = small(turns, turns.count())
    on = ["wild", "part", "turn"]
    left = members.join(turns, on[:2]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).select(*on, "id", "fp", "component")
    right = outside.join(turns, on[:2]).withColumn("turn", F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns")).cast("int")).select(*on, "id", "fp", "component")

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        (i, f, c), (j, g, d) = ([t[n].to_numpy() for n in ("id", "fp", "component")] for t in (x, y))
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for at in range(0, len(j), 128):
            near = (np.bitwise_count(g[at : at + 128, None].view(np.uint64) ^ f[None].view(np.uint64)) <= settings.distance) & (d[at : at + 128, None] != c[None])
            p, q = np.nonzero(near)
            a.append(np.minimum(j[at + p], i[q]))
            b.append(np.maximum(j[at + p], i[q]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(meet, "a long, b long")


def without_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", settings: Resemblance = Resemblance()) -> DataFrame:
    """The rows of docs of which none of the same group stands before them, as deduplicated(); groups are of links by resemblance."""
    plain, names = hidden(docs)
    key = names[key]
    rows = bucketed(plain.withColumn("_row", F.monotonically_increasing_id()), "simhash-rows", "_row")
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_row").alias("row"))
    texts = rows.select("_row", F.col(names[text]).alias("_text"))
    with passing(docs.sparkSession):  # only the rows that go are needed from here on
        slim = stored(sketches(rows.select(F.col(key), "_row", F.col(names[text]).alias("_text")), "_text", settings), "simhash-sketches", 1000)
        nodes = stored(slim.groupBy("_set").agg(F.min(rank).alias("least"), F.count("*").alias("n"), F.min("fp").alias("fp"), F.min("keys").alias("keys"), F.min("_row").alias("row")).withColumn("id", F.monotonically_increasing_id()), "simhash-nodes")
        wide = _lowest(nodes, "_set", resembling(nodes, texts, settings))
        gone = cut(slim.select(key, "_row", "_set").join(wide, "_set").filter(~rank.eqNullSafe(F.col("first"))).select(F.col("_row").alias("_gone")))
    return rows.join(gone.hint("shuffle_hash"), rows["_row"] == F.col("_gone"), "left_anti").select(*shown(names))

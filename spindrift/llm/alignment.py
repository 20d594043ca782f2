"""Cross-tokenizer alignment: which ids of two vocabularies stand for the same bytes, and how often over a corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import small, stored
from spindrift.llm.subwords import BytePairs, Pieces, Words, slices, spread


@dataclass(frozen=True)
class Settings:
    """slice_bytes: of text that are encoded together, a block. crowd: postings of a pair that meet in one task at least;
    heavy: and that so many pairs at most may exceed. full: links of a group that are listed one by one."""

    slice_bytes: int = 5 << 20
    crowd: int = 20_000
    heavy: int = 10_000
    full: int = 256


class _Units:
    """The tokens of units by both vocabularies, cut into groups where tokens of both end."""

    def __init__(self, words: Words, a: BytePairs, b: Pieces, full: int):
        raw = pc.binary_join_element_wise("", pa.array([*words.plain, *words.wholes], pa.string()), " ").cast(pa.binary())
        size = pc.binary_length(raw).to_numpy().astype(np.int64)
        self.n = len(raw)
        (ids_a, n_a), (ids_b, n_b) = words.encode(a), words.encode(b)
        self.good = _same(raw, size, a, ids_a, n_a) & _same(raw, size, b, ids_b, n_b)
        ids_a, ids_b = ids_a[np.repeat(self.good, n_a)], ids_b[np.repeat(self.good, n_b)]
        self.n_a, self.n_b = np.where(self.good, n_a, 0), np.where(self.good, n_b, 0)
        # All units end to end: as each ends where a token of both ends, no group reaches over one.
        ends_a, ends_b = np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b])
        cuts = ends_a[np.append(ends_b, -1)[np.searchsorted(ends_b, ends_a)] == ends_a]
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        unit = np.searchsorted(np.cumsum(np.where(self.good, size, 0)), cuts)
        self.n_groups = np.bincount(unit, minlength=self.n)
        self.n_links = np.bincount(unit, in_a * in_b, self.n).astype(np.int64)
        self.groups = self._told(a.told[ids_a], of_a, in_a, b.told[ids_b], of_b, in_b)
        self._pairs(ids_a, of_a, in_a, ids_b, in_b, unit, full)

    def _told(self, ids_a: np.ndarray, of_a: np.ndarray, in_a: np.ndarray, ids_b: np.ndarray, of_b: np.ndarray, in_b: np.ndarray) -> list[str]:
        """Of each unit its groups: the ids of one vocabulary, then of the other, which come in decimal."""
        n = len(ids_a) + len(ids_b)
        out = np.full(2 * n, ",", object)
        # A group's ids of one vocabulary stand behind those of all earlier groups, of either one.
        place_a, place_b = np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[of_a], np.arange(len(ids_b)) + np.cumsum(in_a)[of_b]
        out[2 * place_a], out[2 * place_b] = ids_a, ids_b
        out[2 * place_a[np.cumsum(in_a) - 1] + 1] = "|"
        out[2 * place_b[np.cumsum(in_b) - 1] + 1] = ";"
        pieces, ends = out.tolist(), np.cumsum(2 * (self.n_a + self.n_b)).tolist()
        return ["".join(pieces[s : e - 1]) if e > s else "" for s, e in zip([0, *ends], ends, strict=False)]

    def _pairs(self, ids_a: np.ndarray, of_a: np.ndarray, in_a: np.ndarray, ids_b: np.ndarray, in_b: np.ndarray, unit: np.ndarray, full: int) -> None:
        """pair, times: of each unit the pairs of ids that it links, and how often at this place; n_pairs: how many of these a unit has."""
        links = in_a * in_b
        ahead = np.flatnonzero(links[of_a] <= full)
        place, row = spread(of_a[ahead], in_b)
        pair = ids_a[ahead][row] << 32 | ids_b[place]
        times, where = np.ones(len(pair), np.int64), unit[of_a[ahead]][row]
        from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        parts = [(pair, times, where)]
        for g in np.flatnonzero(links > full).tolist():  # of such a group each id counts once, with its number
            x, nx = np.unique(ids_a[from_a[g] : from_a[g] + in_a[g]], return_counts=True)
            y, ny = np.unique(ids_b[from_b[g] : from_b[g] + in_b[g]], return_counts=True)
            parts.append(((x[:, None] << 32 | y).ravel(), (nx[:, None] * ny).ravel(), np.full(len(x) * len(y), unit[g])))
        pair, times, where = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(where, kind="stable")
        self.pair, self.times, self.n_pairs = pair[order], times[order], np.bincount(where, minlength=self.n)


def _same(raw: pa.Array, size: np.ndarray, by: BytePairs | Pieces, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which units are the bytes of their tokens."""
    ends = np.cumsum(counts)
    told = np.concatenate([[0], np.cumsum(by.size[ids])])
    same = told[ends] - told[ends - counts] == size
    got = _end_to_end(by.bytes.take(pa.array(ids)))
    if same.all() and np.array_equal(got, _end_to_end(raw)):
        return same
    starts = np.cumsum(size) - size
    every = _end_to_end(raw)
    for i in np.flatnonzero(same).tolist():
        same[i] = np.array_equal(got[told[ends[i] - counts[i]] : told[ends[i]]], every[starts[i] : starts[i] + size[i]])
    return same


def _end_to_end(values: pa.Array) -> np.ndarray:
    at = np.frombuffer(values.buffers()[1], np.int32)[[values.offset, values.offset + len(values)]]
    return np.frombuffer(values.buffers()[2] or b"", np.uint8)[at[0] : at[1]]


def _block(texts: pa.Array, a: BytePairs, b: Pieces, full: int) -> tuple[list[pa.Array], list[pa.Array]]:
    """Of a slice of texts the counts and groups of each, and the postings: for each pair and each number of times that a
    text links it, these texts' places in the slice."""
    texts = texts.fill_null("")
    words = Words(texts)
    units = _Units(words, a, b, full)
    if len(odd := np.unique(words.text[~units.good[words.unit] & (words.unit < len(words.plain))])):
        words.as_wholes(texts, odd)  # only as a whole it can tell whether its bytes are the text's
        units = _Units(words, a, b, full)
    n = len(texts)
    sums = [np.bincount(words.text, x[words.unit], n).astype(np.int64) for x in (units.n_a, units.n_b, units.n_groups, units.n_links)]
    told = list(map(units.groups.__getitem__, words.unit.tolist()))
    ends = np.cumsum(np.bincount(words.text, minlength=n)).tolist()
    groups = [";".join(told[s:e]) for s, e in zip([0, *ends], ends, strict=False)]

    used = pc.value_counts(pa.array(words.text * max(units.n, 1) + words.unit))
    often = used.field(1).to_numpy()
    text, unit = np.divmod(used.field(0).to_numpy(), max(units.n, 1))
    place, row = spread(unit, units.n_pairs)
    numbered = pa.array(units.pair).dictionary_encode()
    pairs, number = numbered.dictionary.to_numpy(), numbered.indices.to_numpy().astype(np.int64)
    key, times = number[place] * n + text[row], units.times[place] * often[row]
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(times, first) if len(first) else times
    number, text = np.divmod(key[first], n)
    order = np.lexsort((text, times, number))
    number, text, times = number[order], text[order], times[order]
    new = np.flatnonzero((np.diff(number, prepend=-1) != 0) | (np.diff(times, prepend=-1) != 0))
    pair = pairs[number[new]]
    offsets = pa.array(np.append(new, len(text)), pa.int32())
    postings = [pa.array(pair >> 32, pa.int32()), pa.array(pair & 0xFFFFFFFF, pa.int32()), pa.array(times[new]), pa.array(np.diff(np.append(new, len(text))), pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(text, pa.int16()))]
    return [*map(pa.array, sums), pa.array(groups, pa.string())], postings


_COUNTS, _POSTINGS = "n_a long, n_b long, n_groups long, n_links long, groups string", "a int, b int, times long, n int, texts array<smallint>"


def encoded(docs: DataFrame, key: str, text: str, a: str, b: str, settings: Settings = Settings()) -> DataFrame:
    """A row a document: key, block, place, n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2,b3`, the ids in decimal);
    and a row for each block of documents, pair of ids and number of times that it is linked in a document, with these
    documents' places: block, a, b, times, n, texts. What is not of a row's kind is null. One pass makes both."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _vocabularies(a, b)
        block = TaskContext.get().partitionId() << 32
        for s in slices(batches, 1, settings.slice_bytes):
            counts, postings = _block(s.column(1), *by, settings.full)
            places = pa.array(np.arange(s.num_rows), pa.int32())
            yield from _rows([s.column(0), _same_value(block, s.num_rows), places, *counts, *(pa.nulls(s.num_rows, p.type) for p in postings)])
            n = len(postings[0])
            yield from _rows([pa.nulls(n, s.column(0).type), _same_value(block, n), pa.nulls(n, pa.int32()), *(pa.nulls(n, c.type) for c in counts), *postings])
            block += 1

    return docs.mapInArrow(run, f"key {kind}, block long, place int, {_COUNTS}, {_POSTINGS}")


def _same_value(x: int, n: int) -> pa.Array:
    return pa.array(np.full(n, x, np.int64))


def _rows(columns: list[pa.Array], step: int = 4000) -> Iterator[pa.RecordBatch]:
    names = ["key", "block", "place", *(c.split()[0] for c in f"{_COUNTS}, {_POSTINGS}".split(", "))]
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for at in range(0, whole.num_rows, step):
        yield whole.slice(at, step)


#: A worker's vocabularies, for the next task of the worker.
_KNOWN: dict[tuple[str, str], tuple[BytePairs, Pieces]] = {}


def _vocabularies(a: str, b: str) -> tuple[BytePairs, Pieces]:
    import spindrift.llm.alignment as here

    return here._KNOWN.get((a, b)) or here._KNOWN.setdefault((a, b), (BytePairs(a), Pieces(b)))


def counted(rows: DataFrame, key: str, settings: Settings = Settings()) -> DataFrame:
    """The documents of encoded(), whose other columns may have been replaced, with n_best and count_sum.

    Postings go to tasks by their ids, and so do the pairs' counts: how many documents hold a pair, and whether no other
    pair of its first id is held by more. Both streams are sorted there and merged, and spill where they must. Each
    posting gives its documents' shares, which are summed a block. A pair of more postings than a crowd is dealt to
    several tasks; of such there are few at any size, as the crowd grows with all postings, and first ids are as many as
    the vocabulary has: both may be broadcast.
    """
    rows = stored(rows, "aligned", 1000)
    postings = rows.filter("a IS NOT NULL").select("block", "a", "b", "times", "n", "texts")
    counts = stored(postings.groupBy("a", "b").agg(F.sum("n").alias("count"), F.count("*").alias("postings")), "counts")
    all_postings = counts.agg(F.sum("postings")).first()[0] or 0
    crowd = max(settings.crowd, all_postings // settings.heavy)
    heavy = stored(counts.filter(F.col("postings") > crowd).select("a", "b", F.ceil(F.col("postings") / crowd).cast("int").alias("parts")), "heavy")
    highest = counts.groupBy(F.col("a").alias("_a")).agg(F.max("count").alias("highest"))
    counts = counts.join(highest, F.col("a") == F.col("_a")).select("a", "b", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    n_heavy = heavy.count()
    parts = F.coalesce("parts", F.lit(1))
    deal = lambda df: df.join(small(heavy, n_heavy, settings.heavy), ["a", "b"], "left")
    counts = deal(counts).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    dealt = deal(postings).withColumn("part", F.pmod(F.xxhash64("block", "times"), parts).cast("int")).drop("parts", "n")
    met = dealt.join(counts.hint("merge"), ["a", "b", "part"])
    shares = met.select("block", "texts", (F.col("times") * F.col("count")).alias("count_sum"), (F.col("times") * F.col("best")).alias("n_best"))
    shares = shares.repartition("block").select("block", F.explode("texts").alias("place"), "count_sum", "n_best")
    sums = shares.groupBy("block", "place").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    documents = rows.filter("place IS NOT NULL").drop("a", "b", "times", "n", "texts")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    others = [c for c in documents.columns if c not in ("key", "block", "place")]
    return documents.join(sums, ["block", "place"], "left").select(F.col("key").alias(key), *others, zero("n_best"), zero("count_sum"))


def aligned(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Every document's alignment: key, n_a, n_b (tokens by either vocabulary), n_groups, n_links, groups, n_best, count_sum.

    a: a byte-level vocabulary of tokenizers, which gets a space and the text; b: a model of sentencepiece, which adds
    the space itself. Bytes at which tokens of both end cut them into groups; all tokens of a group of either kind are
    linked. groups has the ids of each group. A pair's count is the number of documents that link it at least once;
    count_sum sums it over a document's links, and n_best counts the links whose pair has the highest count of its first
    id, ties included.

    Null and empty texts, and those whose tokens by a or b aren't the bytes of a space and the text, have no tokens:
    zeros, and '' for groups. Repeated rows and keys, and null keys, are documents of their own; a table without rows
    gives none. Columns other than key and text aren't read.
    """
    return counted(encoded(docs, key, text, a, b, settings), key, settings)

"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's units are characters: symbol 0 bounds a text, the last one is any character that the trusted text lacks, and
those between are its characters, so an n-gram is a whole number below 2 ** (15 * n). Where the trusted text has more
than 32,766 characters, as Han and Hangul together may, its rarest are two symbols each, both of a set kept for such
pairs; so each character has a code of its own, and its probability is the product of its symbols'.

Counts are tables sharded by n-gram, and stay so: the model is joined of them, the n-grams of the documents are joined
with the model, and each block of documents is joined with the probabilities of its own n-grams, which are those that
its documents are made of. No task and not the driver ever holds the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from spindrift.llm.shared import cut, fresh, passing, release, short_batches, small, stored

SYMBOLS, ORDER = 64, 4
#: The models: of one half of the trusted texts, of the other, and of all.
HALVES, WHOLE = (0, 1), 2
_CODES = 0x110000
#: Texts whose characters stand in arrays at a time.
AT_ONCE = 200
#: Different four-grams that a task holds while it counts.
MOST = 1_000_000


@dataclass(frozen=True)
class Settings:
    """quantile: of the trusted texts' excess in each language, above which a text is rejected. accuracy: of the
    approximate quantile (1 / accuracy is its error in rank). weight: symbols that a text needs for half of its log
    perplexity's distance from the language's median to count, as that of a few symbols varies far more. symbols: of the
    alphabet, a power of two up to 2 ** 15, at which every character of Unicode can have a code of its own. block: bytes of the documents that are scored together."""

    quantile: float = 0.995
    accuracy: int = 20_000
    weight: int = 100
    symbols: int = 1 << 15
    block: int = 8 << 20


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")


def coded(characters: list[int], symbols: int) -> dict[int, int]:
    """Symbols by character, of characters that differ, the frequent ones first: 1 to symbols - 2, one each. If these are
    too few, the last of them are kept for pairs, no more than are needed, and the characters that are left have one pair
    each, as first * symbols + second."""
    paired = 0
    while (single := symbols - 2 - paired) + paired**2 < len(characters):
        paired += 1
        if paired > symbols - 2:
            raise ValueError(f"{len(characters)} characters are more than {symbols} symbols can tell apart, singly and in pairs")
    found = {c: i + 1 for i, c in enumerate(characters[:single])}
    return found | {c: (single + 1 + i // paired) * symbols + single + 1 + i % paired for i, c in enumerate(characters[single:])}


def alphabet(texts: DataFrame, symbols: int = SYMBOLS) -> dict[int, int]:
    """Symbols by code point (see coded()) of texts(text): all its characters, by their number over all of it, ties to the
    smaller code point. The driver gets a row a character that occurs, so no more than Unicode has code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CODES, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                total += np.bincount(_codes([t for t in b.column(0).slice(at, AT_ONCE).to_pylist() if t]), minlength=_CODES)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["code", "n"])

    per = texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return coded([r["code"] for r in per.orderBy(F.desc("n"), "code").collect()], symbols)


def _lookup(letters: dict[int, int], symbols: int) -> np.ndarray:
    table = np.full(_CODES, symbols - 1, np.uint16 if max(letters.values()) < symbols else np.uint32)
    table[list(letters)] = list(letters.values())
    return table


def _grams(texts: list[str], table: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The four-grams that end at each symbol and at the text's end, of all texts in turn, and each text's number of them."""
    length, values = np.fromiter(map(len, texts), np.int64, len(texts)), table[_codes(texts)]
    pairs = values >= symbols
    if pairs.any():
        to = np.cumsum(1 + pairs)
        first = to[pairs] - 2
        length = np.diff(np.concatenate([[0], to])[np.concatenate([[0], np.cumsum(length)])])
        halves = np.repeat(values % symbols, 1 + pairs)
        halves[first] = values[pairs] // symbols
        values = halves
    pad = ORDER - 1
    row = np.zeros(int(length.sum()) + (pad + 1) * len(texts) + pad, np.int64)
    starts = np.cumsum(length + pad + 1) - (length + 1)  # of each text's characters
    if len(texts):
        own = np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        row[own] = values
    every = np.zeros(len(row) - pad, np.int64)
    for k in range(ORDER):
        every = every * symbols + row[k : k + len(every)]
    n = length + 1
    ends = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return every[ends - pad], n


def counts(texts: DataFrame, letters: dict[int, int], symbols: int = SYMBOLS) -> DataFrame:
    """(fold, gram, c): four-grams over all of texts(fold, text), fold being 0 or 1. A task adds up what it has counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, top = _lookup(letters, symbols), symbols**ORDER
        keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                rows = [(f, t) for f, t in zip(b.column(0).slice(at, AT_ONCE).to_pylist(), b.column(1).slice(at, AT_ONCE).to_pylist(), strict=True) if t]
                grams, n = _grams([t for _, t in rows], table, symbols)
                new, c = np.unique(grams + np.repeat(np.array([f for f, _ in rows], np.int64) * top, n), return_counts=True)
                keys, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
                sums = np.bincount(where, np.concatenate([sums, c]), len(keys)).astype(np.int64)
                if len(keys) > MOST:  # the rest of the sum is the shuffle's
                    yield pa.RecordBatch.from_arrays([pa.array(keys // top), pa.array(keys % top), pa.array(sums)], names=["fold", "gram", "c"])
                    keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys // top), pa.array(keys % top), pa.array(sums)], names=["fold", "gram", "c"])

    return texts.select("fold", "text").mapInArrow(run, "fold long, gram long, c long").groupBy("fold", "gram").agg(F.sum("c").alias("c"))


def discounts(n: list[int]) -> list[float]:
    """D1, D2 and D3+ from the numbers of n-grams counted one to four times (Chen and Goodman, 1998); where a number is
    missing, the share that is left of it."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return [min(k, max(0.01, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else min(k, 0.5 + 0.25 * k) for k in (1, 2, 3)]


@dataclass(frozen=True)
class Model:
    """letters, and for each order from 1 up the tables (m, gram, p) of the n-grams seen and (m, context, backoff) of
    their contexts; m tells the models, and models are those that have learned anything."""

    letters: dict[int, int]
    levels: list[tuple[DataFrame, DataFrame]]
    models: set[int]
    symbols: int = SYMBOLS


def estimate(fours: DataFrame, letters: dict[int, int], symbols: int = SYMBOLS) -> Model:
    """Of fours(m, gram, c): all models in the same joins.

    The four-grams keep their counts, and shorter ones have the number of symbols seen before them. Every join is by
    gram, context or suffix, whose hash shards both sides; three numbers of each model and order reach the driver.
    """
    bits = symbols.bit_length() - 1
    levels = {ORDER: cut(fours)}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = cut(levels[n + 1].groupBy("m", (F.col("gram") % symbols**n).alias("gram")).agg(F.count("*").alias("c")))
    out: list[tuple[DataFrame, DataFrame]] = []
    models: set[int] = set()
    for n in range(1, ORDER + 1):
        numbers = levels[n].groupBy("m").agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).collect()
        models |= {r["m"] for r in numbers}
        off: Column = F.lit(None).cast("double")
        for m, *found in numbers:
            d = discounts(found)
            off = F.when(F.col("m") == m, F.when(F.col("c") == 1, F.lit(d[0])).when(F.col("c") == 2, F.lit(d[1])).otherwise(F.lit(d[2]))).otherwise(off)
        level = levels[n].withColumn("context", F.shiftright("gram", bits)).withColumn("d", off)
        contexts = cut(level.groupBy("m", "context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("backoff")))
        joined = level.join(contexts, ["m", "context"])
        if n == 1:
            lower = F.lit(1.0 / symbols)
        else:
            below = out[-1][0].select("m", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            joined, lower = joined.withColumn("suffix", F.col("gram") % symbols ** (n - 1)).join(below, ["m", "suffix"]), F.col("lower")
        out.append((cut(joined.select("m", "gram", (F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("backoff") * lower).alias("p"))), contexts.select("m", "context", "backoff")))
    return Model(letters, out, models, symbols)


def train(texts: DataFrame, symbols: int = SYMBOLS) -> Model | None:
    """Of all of texts(text): the model of them and those of their halves, by a hash of the text. None if there are no characters.

    The texts are counted once; a half's counts are added to the whole's.
    """
    letters = alphabet(texts, symbols)
    if not letters:
        return None
    every = cut(counts(texts.select(fold(F.col("text")).alias("fold"), "text"), letters, symbols))
    each = every.select(F.explode(F.array(F.col("fold").cast("int"), F.lit(WHOLE))).alias("m"), "gram", "c")
    return estimate(each.groupBy("m", "gram").agg(F.sum("c").alias("c")), letters, symbols)


def fold(text: Column) -> Column:
    """0 or 1, the same for equal texts."""
    return F.pmod(F.xxhash64(text), F.lit(2)).cast("int")


def probabilities(asked: DataFrame, model: Model) -> DataFrame:
    """(m, gram, p) of asked(m, gram), different four-grams: of those seen the model's p, of others the backed-off one of their suffix.

    From one symbol up, each order's n-grams meet the tables of n-grams, contexts and shorter n-grams in joins by these keys.
    """
    bits, known = model.symbols.bit_length() - 1, None
    for n, (grams, contexts) in enumerate(model.levels, 1):
        own = asked if n == ORDER else asked.select("m", (F.col("gram") % model.symbols**n).alias("gram")).distinct()
        own = own.withColumn("context", F.shiftright("gram", bits)).join(grams, ["m", "gram"], "left").join(contexts, ["m", "context"], "left")
        if known is None:
            lower = F.lit(1.0 / model.symbols)
        else:
            own = own.withColumn("suffix", F.col("gram") % model.symbols ** (n - 1)).join(known.select("m", F.col("gram").alias("suffix"), F.col("p").alias("lower")), ["m", "suffix"])
            lower = F.col("lower")
        known = cut(own.select("m", "gram", F.coalesce("p", F.coalesce(F.col("backoff"), F.lit(1.0)) * lower).alias("p")))
    return known


def _blocks(batches: Iterator[pa.RecordBatch], text: int, model: int, size: int) -> Iterator[tuple[int, int, list[pa.RecordBatch]]]:
    """(model, name, batches) of blocks of about so many bytes of text of one model: the name is a digest of their texts."""
    held: dict[int, tuple[list[pa.RecordBatch], xxhash.xxh3_64, list[int]]] = {}

    def closed(m: int) -> tuple[int, int, list[pa.RecordBatch]]:
        parts, digest, _ = held.pop(m)
        return m, digest.intdigest() - (1 << 63), parts

    for whole in batches:
        for m in pc.unique(whole.column(model)).to_pylist():
            own = whole.filter(pc.equal(whole.column(model), m))
            at = 0
            for i, t in enumerate(_texts(own, text)):
                parts, digest, length = held.setdefault(m, ([], xxhash.xxh3_64(str(m)), [0]))
                raw = t.encode("utf-8", "surrogatepass")
                digest.update(raw)
                digest.update(b"\0")
                length[0] += len(raw)
                full = length[0] >= size  # known by the rows so far, however they come in batches
                if full or i + 1 - at == AT_ONCE or i + 1 == own.num_rows:
                    parts.append(own.slice(at, i + 1 - at))
                    at = i + 1
                if full:
                    yield closed(m)
    for m in sorted(held):
        yield closed(m)


def _texts(b: pa.RecordBatch, at: int) -> list[str]:
    return [t or "" for t in b.column(at).to_pylist()]


def scored(docs: DataFrame, model: Model, m: Column, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs with perplexity and symbols in the last columns (replacing columns of these names), under the model that m names.

    Texts are read twice. First each block of documents lists its different n-grams; all that occur are joined with the
    model once, and the blocks' lists with what that gives. Then the blocks themselves, compressed, meet their lists. A
    block holds a bounded number of characters, or one longer text, and a list is at most twice as long as its block. docs
    must read the same twice, as files do: a block that finds no list is an error. symbols counts a text's characters and
    its end, which the perplexity is by. A null or empty text: null and 0.
    """
    made = ["perplexity", "symbols"]
    kept = [c for c in docs.columns if c not in made or c == text]
    ready = docs.select(*kept, m.cast("int").alias(fresh(docs, "_m")))
    at, of, letters, symbols, size = kept.index(text), len(kept), model.letters, model.symbols, settings.block
    schema = StructType([*docs.select(*kept).schema.fields, StructField(made[0], DoubleType()), StructField(made[1], LongType())])
    names = schema.names

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _lookup(letters, symbols)
        for m, name, parts in _blocks(batches, at, of, size):
            grams = np.unique(np.concatenate([np.unique(_grams(_texts(b, at), table, symbols)[0]) for b in parts]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), m, np.int32)), pa.array(np.full(len(grams), name)), pa.array(grams)], names=["m", "block", "gram"])
        release()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, name, parts in _blocks(batches, at, of, size):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for b in parts:
                    out.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])
        release()

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, first = np.unique(right["gram"].to_numpy(), return_index=True)
        logs, table, out = np.log(right["p"].to_numpy()[first]), _lookup(letters, symbols), []
        for rows in left["rows"]:  # equal blocks, if any, share a name
            for b in pa.ipc.open_stream(rows.as_buffer()):
                texts = _texts(b, at)
                every, n = _grams(texts, table, symbols)
                different, where = np.unique(every, return_inverse=True)
                place = np.minimum(np.searchsorted(grams, different), max(0, len(grams) - 1))
                if not len(grams) or (grams[place] != different).any():
                    raise RuntimeError("a block of documents has no list of its n-grams: the table must read the same twice; write it first")
                sums = np.add.reduceat(logs[place][where], np.cumsum(n) - n)
                found = [(math.exp(-x / (len(t) + 1)), len(t) + 1) if t else (None, 0) for t, x in zip(texts, sums.tolist(), strict=True)]
                columns = [pa.array([x for x, _ in found], pa.float64()), pa.array([k for _, k in found], pa.int64())]
                out.append(pa.RecordBatch.from_arrays([*b.columns[:of], *columns], names=names))
        release()
        return pa.Table.from_batches(out, None if out else to_arrow_schema(schema))

    pairs = stored(ready.mapInArrow(lists, "m int, block long, gram long"), "quality-lists", 1000)
    known = probabilities(pairs.select("m", "gram").distinct(), model)
    right = pairs.join(known, ["m", "gram"]).select("block", "gram", "p")
    left = ready.mapInArrow(packed, "block long, rows binary")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(judge, schema)


def trusted(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The docs that labels(doc_id, quality, toxic) call good and not toxic; a document that any row calls otherwise is not."""
    good = labels.groupBy(F.col("doc_id").alias("_good")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).filter("q = 1 AND coalesce(t, 0) = 0 AND _good IS NOT NULL").select("_good")
    good = cut(good)
    return docs.join(small(good, good.count()).withColumnRenamed("_good", name := fresh(docs, "_good")), docs[key] == F.col(name), "left_semi")


def thresholds(good: DataFrame, model: Model, settings: Settings = Settings()) -> tuple[DataFrame, float, float]:
    """Of good(text, lang): a table (lang, middle, above) of the median of log perplexity by language and the quantile of
    the excess over it, which counts by the text's length; and these two of all.

    Each text is scored by the half of the texts that it isn't of: scored by what learned it, it would seem better than
    any new text can. Where all texts are of one half, by the whole.
    """
    other = F.lit(WHOLE)
    for half in HALVES:
        if half in model.models:
            other = F.when(fold(F.col("text")) == 1 - half, F.lit(half)).otherwise(other)
    x = scored(good.filter("text <> ''"), model, other, "text", settings).select("lang", F.ln("perplexity").alias("x"), F.col("symbols").alias("n"))
    x = cut(x)

    def level(value: Column, quantile: float) -> Column:
        return F.percentile_approx(value, quantile, settings.accuracy)

    counted = F.col("n") / (F.col("n") + settings.weight)
    middle = x.agg(level(F.col("x"), 0.5)).first()[0]
    above = x.agg(level((F.col("x") - F.lit(middle)) * counted, settings.quantile)).first()[0]
    by = cut(x.groupBy(F.col("lang").alias("l")).agg(level(F.col("x"), 0.5).alias("middle")))
    each = x.join(small(by, by.count()), F.col("lang").eqNullSafe(F.col("l")))
    return cut(each.groupBy("lang").agg(F.max("middle").alias("middle"), level((F.col("x") - F.col("middle")) * counted, settings.quantile).alias("above"))), middle, above


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """docs with perplexity, symbols, threshold and keep (replacing columns of these names).

    keep: the perplexity isn't above the threshold of the trusted texts of the same language (of all trusted texts, if
    the language has none; a null language is one), which is higher for a shorter text. A null or empty text isn't kept.
    Without any trusted text there is no threshold, and every text with a character is kept. Equal texts of one language
    are judged alike; repeated rows stay; an empty table gives an empty one.
    """
    spark, made = docs.sparkSession, ["perplexity", "symbols", "threshold", "keep"]
    good = trusted(docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")), labels, "key").select("lang", "text")
    with short_batches(spark):
        model = train(good, settings.symbols)
    kept = docs.select(*[c for c in docs.columns if c not in made or c in (text, lang, key)])
    full = F.coalesce(F.length(text) > 0, F.lit(False))
    if model is None:
        return kept.withColumns({"perplexity": F.lit(None).cast("double"), "symbols": F.lit(0).cast("long"), "threshold": F.lit(None).cast("double"), "keep": full})
    with short_batches(spark), passing(spark):
        by, middle, above = thresholds(good, model, settings)
    own = [fresh(kept, name) for name in ("_lang", "_middle", "_above")]
    found = scored(kept, model, F.lit(WHOLE), text, settings)
    found = found.join(small(by, by.count()).toDF(*own), F.col(lang).eqNullSafe(F.col(own[0])), "left")
    length = (F.col("symbols") + settings.weight) / F.col("symbols")
    level = F.exp(F.coalesce(F.col(own[1]), F.lit(middle)) + F.coalesce(F.col(own[2]), F.lit(above)) * length)
    found = found.withColumn("threshold", F.when(F.col("symbols") > 0, level))
    return found.withColumn("keep", full & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).select(*kept.columns, *[c for c in made if c not in kept.columns])

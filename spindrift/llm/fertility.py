"""Quality rules: what tokens of public vocabularies tell of a text, and bands for each language or script."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import small, stored
from spindrift.llm.subwords import BytePairs, Pieces, Words, slices, spread


@dataclass(frozen=True)
class Settings:
    """least_words, most_repeated: of the base rules, words and percent. fence: interquartile ranges by which a measure
    may lie outside its quartiles. slack: and how far outside in any case, as a share of the median for characters a token
    and entropy, as a number for the fallback share. least_texts: that a band is taken from. slice_bytes: of text that are
    encoded together. accuracy: of the quartiles, as Spark's percentile_approx takes it."""

    least_words: int = 50
    most_repeated: int = 50
    fence: float = 3.0
    slack: float = 0.1
    fallback_slack: float = 0.02
    least_texts: int = 100
    slice_bytes: int = 12 << 20
    accuracy: int = 10_000


# Scripts by their code points; letters of any other count as Other.
SCRIPTS = {
    "Latin": "A-Za-zªºÀ-ÖØ-öø-ɏḀ-ỿ",
    "Greek": "Ͱ-Ͽἀ-῿",
    "Cyrillic": "Ѐ-ԯ",
    "Hebrew": "֐-׿",
    "Arabic": "؀-ۿݐ-ݿ",
    "Devanagari": "ऀ-ॿ",
    "Thai": "฀-๿",
    "Hangul": "ᄀ-ᇿ가-힯",
    "Kana": "぀-ヿ",
    "Han": "㐀-䶿一-鿿",
}
#: What is measured of a text's tokens; each has a band.
MEASURES = ("characters_a", "characters_b", "fallback", "entropy")
_COUNTED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens_a long, n_tokens_b long, characters_a double, characters_b double, fallback double, entropy double, script string"


def _base(raw: pa.Array, texts: list[str]) -> dict[str, np.ndarray]:
    """The base counts of texts and their UTF-8; words stand between white space of ASCII."""
    whole = raw.to_pylist()
    words = [b.split() for b in whole]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = pa.array([w for ws in words for w in ws], pa.binary())
    of = np.repeat(np.arange(len(words)), counts)
    in_words = np.bincount(of, pc.binary_length(flat).to_numpy(zero_copy_only=False), len(words)).astype(np.int64)
    white = np.fromiter(map(len, whole), np.int64, len(whole)) - in_words
    lines = [[x for x in b.split(b"\n") if x.strip()] for b in whole]
    return {
        "n_words": counts,
        "word_chars": np.fromiter(map(len, texts), np.int64, len(texts)) - white,
        "n_symbols": np.array([sum(map(t.count, "#*$%&|<>")) for t in texts], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": np.bincount(of, _repeated(flat, of), len(words)).astype(np.int64),
    }


def _repeated(words: pa.Array, of: np.ndarray) -> np.ndarray:
    """Which words, one after the other, stand in a window of three that occurs again in the same text; of: the texts of words."""
    out = np.zeros(len(of), bool)
    if len(of) < 3:
        return out
    at = np.flatnonzero(of[2:] == of[:-2])
    word = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    two = pa.array(word[at] << 32 | word[at + 1]).dictionary_encode().indices.to_numpy().astype(np.int64)
    three = pa.array(two << 32 | word[at + 2]).dictionary_encode().indices.to_numpy().astype(np.int64)
    order = np.lexsort((of[at], three))
    same = (np.diff(three[order]) == 0) & (np.diff(of[at][order]) == 0)
    again = at[order[np.append(same, False) | np.insert(same, 0, False)]]
    for i in range(3):
        out[again + i] = True
    return out


def _tokens(texts: pa.Array, a: BytePairs, b: Pieces) -> dict[str, np.ndarray]:
    """Of each text the tokens by either vocabulary, and by the second one the share of bytes and the entropy in bits."""
    words, n = Words(texts), len(texts)
    counts = {}
    (_, n_a), (ids, n_b) = words.encode(a), words.encode(b)
    counts["n_tokens_a"], counts["n_tokens_b"] = (np.bincount(words.text, x[words.unit], n).astype(np.int64) for x in (n_a, n_b))
    place, row = spread(words.unit, n_b)
    text, token = words.text[row], ids[place]
    kinds = len(b.bytes)
    found = pc.value_counts(pa.array(text * kinds + token))
    times, text_of = found.field(1).to_numpy(), found.field(0).to_numpy() // kinds
    of_bytes = np.bincount(text_of, times * b.fallback[found.field(0).to_numpy() % kinds], n)
    with np.errstate(divide="ignore", invalid="ignore"):
        total = counts["n_tokens_b"].astype(float)
        counts["fallback"] = of_bytes / total
        counts["entropy"] = np.log2(total) - np.bincount(text_of, times * np.log2(times), n) / total
    return counts


def _script(t: str) -> str | None:
    """The script of most letters; of equally many the first of SCRIPTS, None without letters."""
    letters = _NO_LETTER.sub("", t)
    if not letters:
        return None
    counts = {name: len(letters) - len(letters := other.sub("", letters)) for name, other in _OF_SCRIPT.items()}
    counts["Other"] = len(letters)
    return max(counts, key=counts.get)


_NO_LETTER = re.compile(r"[\W\d_]+")
_OF_SCRIPT = {name: re.compile(f"[{points}]+") for name, points in SCRIPTS.items()}


def _measured(texts: pa.Array, a: BytePairs, b: Pieces) -> list[pa.Array]:
    texts = texts.fill_null("")
    listed = texts.to_pylist()
    found = {**_base(texts.cast(pa.binary()), listed), **_tokens(texts, a, b)}
    points = np.fromiter(map(len, listed), np.int64, len(listed))
    with np.errstate(divide="ignore", invalid="ignore"):
        found["characters_a"], found["characters_b"] = points / found["n_tokens_a"], points / found["n_tokens_b"]
    out = [pa.array(found[c], mask=found["n_tokens_b"] == 0 if c in MEASURES else None) for c in (x.split()[0] for x in _COUNTED.split(", ")) if c != "script"]
    return [*out, pa.array(list(map(_script, listed)), pa.string())]


_KNOWN: dict[tuple[str, str], tuple[BytePairs, Pieces]] = {}


def measured(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """key, lang, and for each text the counts of the base rules (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words), tokens by a byte-level vocabulary a and by pieces b, characters a token by both, the share of b's
    tokens that are single bytes, the entropy of b's tokens in bits, and the script of most letters. One narrow pass.

    Null and empty texts have counts of 0 and no measures; nor has any text without tokens."""
    docs = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("key", "lang")]
    names = ["key", "lang", *(x.split()[0] for x in _COUNTED.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import spindrift.llm.fertility as here

        by = here._KNOWN.get((a, b)) or here._KNOWN.setdefault((a, b), (BytePairs(a), Pieces(b)))
        for s in slices(batches, 2, settings.slice_bytes):
            yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), *_measured(s.column(2), *by)], names=names)

    return docs.mapInArrow(run, ", ".join([*kinds, _COUNTED]))


def _length() -> Column:
    """Texts of between n and 4 n tokens are of one length: entropy grows with it, and short texts vary more."""
    return F.floor(F.log2("n_tokens_b") / 2).cast("int")


def bands(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(of, length, low and high of every measure): from the quartiles of all texts that pass the base rules, by language
    or, with no language, by script; by length, and with length null over all lengths. Bands of fewer than least_texts aren't given."""
    good = rows.filter("NOT base_failed AND n_tokens_b > 0").withColumn("length", F.explode(F.array(_length(), F.lit(None).cast("int"))))
    quartiles = [F.percentile_approx(m, [0.25, 0.5, 0.75], settings.accuracy).alias(m) for m in MEASURES]
    found = good.groupBy("of", "length").agg(F.count("*").alias("n"), *quartiles).filter(F.col("n") >= settings.least_texts)

    def around(m: str) -> list[Column]:
        low, middle, high = (F.col(m)[i] for i in range(3))
        slack = F.lit(settings.fallback_slack) if m == "fallback" else settings.slack * middle
        reach = F.greatest(settings.fence * (high - low), slack)
        return [(low - reach).alias(f"{m}_low"), (high + reach).alias(f"{m}_high")]

    return found.select("of", "length", *[c for m in MEASURES for c in around(m)])


def judged(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """measured() with base_failed, outside (the measures that lie outside of their bands) and kept.

    base_failed: fewer words than least_words, or more than most_repeated percent of them in windows of three words that
    occur twice or more in the text. A text that fails the base rules isn't kept, nor is one of which a measure lies
    outside the band of its language (with a null language, of its script) and length; where too few texts are of that
    length the band of all lengths is taken, and where there is none the text is kept. Repeated rows and null keys are
    documents of their own, and count in the bands; a table without rows gives none. Columns other than key, text and
    lang aren't read, so their names don't matter.
    """
    failed = (F.col("n_words") < settings.least_words) | (100 * F.col("n_repeat_words") > settings.most_repeated * F.col("n_words"))
    of = F.coalesce(F.concat(F.lit("language "), F.col("lang").cast("string")), F.concat(F.lit("script "), F.col("script")), F.lit("none"))
    rows = stored(measured(docs, a, b, key, text, lang, settings).withColumn("base_failed", failed).withColumn("of", of), "measured", 1000)
    limits = stored(bands(rows, settings), "bands")
    n = limits.count()
    sides = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    exact = limits.select(F.col("of").alias("_of"), F.col("length").alias("_length"), *[F.col(c).alias(f"_{c}") for c in sides]).filter("_length IS NOT NULL")
    every = limits.filter("length IS NULL").drop("length")
    rows = rows.join(small(exact, n), (F.col("of") == F.col("_of")) & (_length() == F.col("_length")), "left").join(small(every, n), "of", "left")
    limit = lambda c: F.coalesce(f"_{c}", c)
    outside = F.array_compact(F.array(*[F.when((F.col(m) < limit(f"{m}_low")) | (F.col(m) > limit(f"{m}_high")), F.lit(m)) for m in MEASURES]))
    rows = rows.withColumn("outside", outside)
    names = [x.split()[0] for x in _COUNTED.split(", ")]
    return rows.select(F.col("key").alias(key), F.col("lang").alias(lang), *names, "base_failed", "outside", (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"))

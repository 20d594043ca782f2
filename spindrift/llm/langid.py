"""Language identification by compression: whichever language's dictionary makes a text smallest."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from spindrift.llm.shared import cut, fresh, unit

UNKNOWN = "und"
#: Texts that stand in Python at a time.
AT_ONCE = 512


@dataclass(frozen=True)
class Settings:
    """dictionary_bytes and sample_documents bound what is learned of each language. dictionaries_bytes: of all
    dictionaries together; where there are so many languages that it doesn't hold, each has an equal part of it, of
    least_bytes at least, else learning is an error. slice_chars: a longer text gives the sample a slice of so many,
    from a place drawn by a hash. chunk_bytes: a text is encoded in chunks, so that the dictionary counts along the
    whole of a long text. level: zstandard's. margin: a text whose two best languages differ by less than this share of
    the best size is rejected. seed: of the sample."""

    dictionary_bytes: int = 110 * 1024
    sample_documents: int = 200
    dictionaries_bytes: int = 32 << 20
    least_bytes: int = 1024
    slice_chars: int = 16 * 1024
    chunk_bytes: int = 1024
    level: int = 5
    margin: float = 0.005
    seed: int = 11


def letters(text: Column) -> Column:
    """The text in lower case with every run of other characters than letters made one space: signs and capitals say nothing of a language."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", settings: Settings = Settings()) -> dict[str, bytes]:
    """Raw-content dictionaries by language, of texts sampled by a hash of key and text: each language is learned.

    Rows whose text, lang or key is null teach nothing, equal rows teach once; no rows give no languages. Counts by
    language come first, so that only about three times sample_documents rows of each reach the window; what the driver
    receives is bounded by the settings. More languages than the dictionaries have room for are an error.
    """
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(lang).alias("l"), F.col(text).alias("t")).filter("k IS NOT NULL AND l IS NOT NULL AND t IS NOT NULL AND t <> ''")
    per = cut(rows.groupBy("l").agg(F.count("*").alias("n")))
    languages, most = per.count(), settings.dictionaries_bytes // settings.least_bytes
    if not languages:
        return {}
    if languages > most:
        raise ValueError(f"{languages} languages; there is room for the dictionaries of {most}")
    room = min(settings.dictionary_bytes, settings.dictionaries_bytes // languages)
    share = F.least(F.lit(1.0), F.lit(3.0 * settings.sample_documents) / F.col("n"))
    u = F.pmod(F.xxhash64(F.lit(settings.seed), "k", "t"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    near = rows.withColumn("u", u).join(F.broadcast(per), "l").filter(F.col("u") < share)
    one = near.groupBy("l", "u").agg(F.min(F.struct("k", "t")).alias("x")).select("l", "u", "x.k", letters(F.col("x.t")).alias("t")).filter("t <> ''")
    over_long = F.greatest(F.length("t") - settings.slice_chars, F.lit(0))
    start = F.floor(unit("k", seed=settings.seed) * (over_long + 1)).cast("int") + 1
    one = one.select("l", "u", "k", F.substring("t", start, F.lit(settings.slice_chars)).alias("t"))
    over = Window.partitionBy("l").orderBy("u", "k", "t")
    taken = one.withColumn("i", F.row_number().over(over)).filter(F.col("i") <= settings.sample_documents)
    taken = taken.withColumn("upto", F.sum(F.octet_length("t")).over(over.rowsBetween(Window.unboundedPreceding, -1))).filter(F.coalesce(F.col("upto"), F.lit(0)) < room)
    parts: dict[str, list[tuple[int, bytes]]] = {}
    for r in taken.select("l", "i", "t").collect():
        parts.setdefault(r["l"], []).append((r["i"], r["t"].encode()))
    return {k: b"\n".join(t for _, t in sorted(v))[-room:] for k, v in sorted(parts.items())}


class Judge:
    """Sizes of a text by language; made once a Python worker."""

    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        self.settings, self.names = settings, sorted(dictionaries)
        self.coders = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=settings.level)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False))

    def sizes(self, raw: bytes) -> list[int]:
        step = self.settings.chunk_bytes
        chunks = [raw[i : i + step] for i in range(0, len(raw), step)]
        return [sum(len(c.compress(x)) for x in chunks) for c in self.coders]

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        """Of what letters() has made: (language, score, margin, rejected): ties go to the first by code point; und, 0, 0 and rejected if there is no letter."""
        if not self.names or not text:
            return UNKNOWN, 0.0, 0.0, True
        raw = text.encode("utf-8", "replace")
        found = self.sizes(raw)
        best = min(range(len(found)), key=lambda i: (found[i], i))
        rest = [x for i, x in enumerate(found) if i != best]
        margin = (min(rest) - found[best]) / found[best] if rest else 1.0
        score = 1 / sum(math.exp(-min(50.0, 100 * (x - found[best]) / found[best])) for x in found)
        return self.names[best], score, margin, margin < self.settings.margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", settings: Settings = Settings(), prefix: str = "") -> DataFrame:
    """docs with lang_pred, score, margin and rejected (each name after prefix; a column of docs of the same name is replaced).

    A narrow transformation over whole texts, of which only the letters go to Python. The dictionaries are broadcast:
    dictionaries_bytes at most. A null or empty text, one without letters, and every text when nothing was learned: und,
    score 0, rejected. Rows keep their number and their other columns; an empty table gives an empty one.
    """
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)
    names = [f"{prefix}lang_pred", f"{prefix}score", f"{prefix}margin", f"{prefix}rejected"]
    kinds = StringType(), DoubleType(), DoubleType(), BooleanType()
    kept = [c for c in docs.columns if c not in names]

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = Judge(held.value, settings)
        for t in texts:
            found = [judge(x) for at in range(0, len(t), AT_ONCE) for x in t.slice(at, AT_ONCE).to_pylist()]
            columns = [pa.array([x[i] for x in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.StructArray.from_arrays(columns, names=names)

    told = F.arrow_udf(run, StructType([StructField(n, k) for n, k in zip(names, kinds, strict=True)])).asNondeterministic()  # else a filter would call it again
    made = docs.select(*[docs[c] for c in kept], told(letters(docs[text])).alias(found := fresh(docs, "_found")))
    return made.select(*kept, *[F.col(found)[n].alias(n) for n in names])

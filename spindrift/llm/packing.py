"""Mixture-controlled packing: deficit round-robin over source queues, cut into sequences of one length."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut, prefixed, running, small, stored, unit
from spindrift.llm.subwords import BytePairs, by_rank, flat


@dataclass(frozen=True)
class Settings:
    """length: tokens in a sequence. window: tokens in a round of the queues. weights: the proportion of each source's
    code-point rank in a window, repeating; none: each source's share of all tokens, so that all queues end together.
    end: the id that closes a document. seed: of the queues' order. per_bucket: documents that meet in one task of a
    running sum. cached: bytes of encoded words that a worker keeps, of a vocabulary that tiktoken can't encode by. least:
    tokens of a window that a source's documents are cut for; one that gets fewer sends whole documents, each when its
    deficit covers it."""

    length: int = 1024
    window: int = 64 * 1024
    weights: tuple[float, ...] = ()
    end: int = 0
    seed: int = 23
    per_bucket: int = 5_000
    cached: int = 80 << 20
    least: float = 32.0


#: Bytes of text that are encoded together: the more, the fewer different words a slice has for its length.
AT_ONCE = 8 << 20

#: Two spaces in a row, or a space between other white space; in the class are all characters that any engine takes for white space.
_CROWDED = "  |{0} {0}".format(r"[\x09-\x0D\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


class Encoder:
    """Ids of whole texts, by what stands between single spaces.

    The pre-tokenizer of byte-level vocabularies starts a token at every space that stands alone, and lets none reach
    over it; so a text without two spaces in a row, or one between other white space, is the ids of its words, each
    with the space before it. A batch's words are numbered by Arrow, and each different word is encoded once; they go
    to the tokenizer in one string, whose ids are told apart by the spaces that they start with. Any other text is
    encoded as it is. Vocabularies that tell pairs apart by rank are encoded by tiktoken, a batch at once; for others
    tokenizers is asked, and words are cached.
    """

    def __init__(self, path: str, cached: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        pairs = BytePairs(path) if by_rank(path) else None
        self.pairs = pairs if pairs and pairs.fast else None
        if self.pairs:
            self.tokenizer = self.pairs.tokenizer
        else:
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(self.tokenizer.get_vocab_size())])
        self.cached, self.held, self.words, self.older = cached, 0, {}, {}

    def whole(self, texts: list[str]) -> list[bytes]:
        if self.pairs:
            return [np.array(ids, self.kind).tobytes() for ids in self.pairs.whole(texts, "")]
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        """Adds words, each behind a space, to the cache."""
        joined = [w for w in words if w and w == w.strip()]
        for at in range(0, len(joined), 512):
            some = joined[at : at + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(some):  # not a vocabulary of this kind after all
                found = self.whole([" " + w for w in some])
            else:
                raw, cuts = ids.tobytes(), [*(starts * self.kind.itemsize).tolist(), len(ids) * self.kind.itemsize]
                found = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            self.words.update(zip(some, found, strict=True))
        if len(joined) < len(words):
            odd = list(set(words).difference(joined))
            self.words.update(zip(odd, self.whole([" " + w for w in odd]), strict=True))
        self._counted(words)

    def _counted(self, words: list[str]) -> None:
        self.held += 3 * sum(map(len, words)) + 200 * len(words)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        texts = texts.fill_null("")
        crowded = pc.match_substring_regex(texts, _CROWDED).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        odd = np.flatnonzero(crowded).tolist()
        for i, ids in zip(odd, self.whole([texts[i].as_py() for i in odd]), strict=True):
            out[i] = ids
        plain = np.flatnonzero(~crowded)
        if len(plain):
            for i, ids in zip(plain.tolist(), self._by_word(texts.take(pa.array(plain))), strict=True):
                out[i] = ids
        return out

    def _by_word(self, texts: pa.Array) -> list[bytes]:
        split = pc.split_pattern(texts, " ")
        starts = np.asarray(split.offsets)[:-1] - split.offsets[0].as_py()
        numbered = split.flatten().dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        # A text's first word has no space before it, and is encoded by itself.
        number = numbered.indices.to_numpy().copy()
        first = [words[i] for i in number[starts]]
        number[starts] = len(words) + np.arange(len(starts))
        ids = (self._at_once if self.pairs else self._kept)(words, first).take(pa.array(number))
        raw, cuts = ids.buffers()[2].to_pybytes(), np.frombuffer(ids.buffers()[1], np.int32)[[*starts.tolist(), len(ids)]].tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _at_once(self, words: list[str], first: list[str]) -> pa.Array:
        """The ids of words, each behind a space, and then of those that are first in a text."""
        (ids, n), (more, m) = self.pairs.words(words), flat(self.pairs.whole(first, ""))
        ids, ends = np.concatenate([ids, more]).astype(self.kind), np.cumsum(np.concatenate([[0], n, m])) * self.kind.itemsize
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])

    def _kept(self, words: list[str], first: list[str]) -> pa.Array:
        """The same by the cache."""
        if self.held > self.cached // 2:  # what is used again comes over from the older half
            self.words, self.older, self.held = {}, self.words, 0
        found = list(map(self.words.get, words))
        if missing := [i for i, ids in enumerate(found) if ids is None]:
            names = [words[i] for i in missing]
            again = {w: self.older[w] for w in names if w in self.older}
            self.words |= again
            self._counted(list(again))
            self.learn([w for w in names if w not in again])
            for i, w in zip(missing, names, strict=True):
                found[i] = self.words[w]
        return pa.array(found + self.whole(first), pa.binary())


#: A worker's encoders by vocabulary: the next task of the worker finds the cache as the last one left it.
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoded(docs: DataFrame, tokenizer: str, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs with the text replaced by _row (a number of its own), _n (ids with the closing one) and _ids (the ids without it)."""
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).withColumns({"_row": F.lit(0).cast("long"), "_n": F.lit(0).cast("long"), "_ids": F.lit(b"")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import spindrift.llm.packing as here

        known = (tokenizer, settings.cached)
        encoder = here._ENCODERS.get(known) or here._ENCODERS.setdefault(known, Encoder(*known))
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            slices = -(-(pc.sum(pc.binary_length(b.column(b.num_columns - 1))).as_py() or 0) // AT_ONCE) or 1
            step = max(1, -(-b.num_rows // slices))
            for at in range(0, b.num_rows, step):
                s = b.slice(at, step)
                ids = encoder(s.column(s.num_columns - 1))
                n = np.array([len(x) // encoder.kind.itemsize + 1 for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays([*s.columns[:-1], pa.array(np.arange(row, row + len(n))), pa.array(n), pa.array(ids, pa.binary())], names=schema.names)
                row += len(n)
        pa.default_memory_pool().release_unused()  # the worker stays for other tasks

    return docs.select(*rest, F.col(text)).mapInArrow(run, schema)


def positions(lengths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Of lengths(_row, _u, _source, _n): (_row, _runs), each document's runs of tokens with their places in the stream
    of all sequences, as structs (from, size, at).

    Deficit round-robin with tokens as its packets: each window gives a queue its quantum, of which whole tokens are
    sent and the fraction is carried to the next; so token t of a queue goes out in window t / quantum. With running
    sums of the queues the windows are known without a turn being played, in all partitions at once, and documents
    are cut where a window's quantum ends. A source of a quantum below least would be cut to single tokens: its packets
    are documents, and one waits until the deficit that is carried from window to window covers it. A running sum over
    the windows, each with its sources in turn, gives the places. A source whose queue has ended leaves its part of later
    windows to the others. So there are no more runs than documents and, for the others, sources of a window.
    """
    per = cut(lengths.groupBy("_source").agg(F.sum("_n").alias("_tokens"), F.count("*").alias("_docs")).withColumn("_one", F.lit(1)))
    n = per.count()
    per = prefixed(per, [F.col("_source").asc_nulls_last()], "_one", "_rank", n)
    weight = F.get(F.array(*[F.lit(float(w)) for w in settings.weights]), F.col("_rank") % len(settings.weights)) if settings.weights else F.col("_tokens").cast("double")
    per = cut(per.withColumn("_w", weight))
    every = per.agg(F.sum("_w")).first()[0]
    per = per.select(F.col("_source").alias("_s"), "_rank", (F.lit(float(settings.window)) * F.col("_w") / F.lit(every)).alias("_quantum"), F.ceil(F.col("_docs") / settings.per_bucket).alias("_buckets"))
    d = lengths.join(small(per, n), F.col("_source").eqNullSafe(F.col("_s"))).select("_row", "_u", "_n", "_rank", "_quantum", "_buckets")
    # Rows of one key have one _u; where they crowd a bucket, they are dealt by their own number.
    d = running(d, ["_rank"], ["_u", "_row"], "_n", "_before", bucket=F.floor(F.col("_u") * F.col("_buckets")), salt=unit("_row", seed=settings.seed), crowd=4 * settings.per_bucket)
    q, before, after, window = F.col("_quantum"), F.col("_before"), F.col("_before") + F.col("_n"), F.col("_window")
    # One window more on either side, as a quotient of doubles may be off at a border; the borders themselves decide.
    rare, last = q < settings.least, F.floor((after - 1) / q).cast("long")
    d = d.withColumn("_window", F.explode(F.when(rare, F.array(F.ceil(after / q).cast("long") - 1)).otherwise(F.sequence(F.floor(before / q).cast("long") - 1, last + 1))))
    start, end = F.when(rare, before).otherwise(F.greatest(before, F.ceil(window * q))), F.when(rare, after).otherwise(F.least(after, F.ceil((window + 1) * q)))
    d = d.select("_row", "_rank", "_window", start.alias("_start"), end.alias("_end"), "_before")
    d = d.filter("_end > _start").select("_row", "_rank", F.greatest("_window", F.lit(0)).cast("long").alias("_window"), "_start", (F.col("_end") - F.col("_start")).alias("_size"), (F.col("_start") - F.col("_before")).alias("_from"))
    d = running(d, [], ["_rank", "_start"], "_size", "_at", bucket=F.col("_window"), group=4096)
    return d.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(F.col("_from").alias("from"), F.col("_size").alias("size"), F.col("_at").alias("at")))).alias("_runs"))


def pack(docs: DataFrame, tokenizer: str, text: str = "text", source: str = "source", key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """A row for each piece of a document: key, source, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Documents are their ids and the closing one, in the stream that positions() gives, cut where a sequence is full:
    every id lies in one piece, and only the last sequence needs padding. A null or empty text is its closing
    id alone; a null source is a source like others, last; rows of equal or null key are documents of their own; an
    empty table gives no pieces. tokenizer: the path of a vocabulary file on every executor.
    """
    if any(w <= 0 for w in settings.weights):
        raise ValueError("weights must be above 0")
    tokens = stored(encoded(docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), F.col(text).alias("_text")), tokenizer, "_text", settings), "packing-ids", 4000)
    places = positions(tokens.select("_row", unit("_key", seed=settings.seed).alias("_u"), "_source", "_n"), settings)
    placed = tokens.join(places, "_row").select("_key", "_source", "_n", "_ids", "_runs")
    schema = placed.select(F.col("_key").alias(key), F.col("_source").alias(source), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"), F.lit(b"").alias("ids"), F.lit(0).cast("long").alias("doc_tokens"), F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    size, end = settings.length, settings.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                b = whole.slice(first, 512)
                runs = b.column(4)
                doc = np.repeat(np.arange(b.num_rows), np.diff(runs.offsets.to_numpy()))
                flat = runs.flatten()
                from_, n, at = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                count = (at + n - 1) // size - at // size + 1
                of = np.repeat(np.arange(len(n)), count)
                sequence = at[of] // size + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                lo, hi = np.maximum(sequence * size, at[of]), np.minimum((sequence + 1) * size, at[of] + n[of])
                start, length, doc = from_[of] + lo - at[of], hi - lo, doc[of]
                total = b.column(2).to_numpy(zero_copy_only=False)
                ids, last, now = [], -1, b""
                for i, a, e in zip(doc.tolist(), start.tolist(), (start + length).tolist(), strict=True):
                    if i != last:
                        raw, last = b.column(3)[i].as_py(), i
                        now = np.append(np.frombuffer(raw, "<u2" if len(raw) == 2 * (total[i] - 1) else "<u4"), end).astype("<u4").tobytes()
                    ids.append(now[4 * a : 4 * e])
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(start), pa.array(length), pa.array(ids, pa.binary()), pa.array(total[doc]), pa.array(sequence), pa.array(lo - sequence * size)], names=schema.names)

    return placed.mapInArrow(run, schema)

"""Tokens of many texts by their different words, for vocabularies of byte pairs and of pieces."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WHITE = r"[\x09-\x0D\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

#: Where tokens may reach over a space: a space at an end or beside another, one between other white space, or the mark that pieces have for a space.
CROWDED = f"^ | $|  |{_WHITE} {_WHITE}|▁"

#: A run of so many characters without white space, or of it, goes to the tokenizer whose time doesn't grow with its square, nor its stack with the run.
LONG = 1000
_LONG = re.compile("[{0}]{{{1}}}|[^{0}]{{{1}}}".format(r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000", LONG))


def by_rank(path: str) -> bool:
    """Whether a vocabulary file of tokenizers is of the kind that BytePairs reads: byte-level pairs without settings of their own."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, split = told["model"], told.get("pre_tokenizer") or {}
    own = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    return (
        model.get("type") == "BPE"
        and not any(model.get(x) for x in own)
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space", True)
        and not any(told.get(x) for x in ("normalizer", "truncation", "padding"))
        and all(t.get("special") for t in told.get("added_tokens", []))
    )


class BytePairs:
    """A byte-level vocabulary file of tokenizers; what it tells apart by rank is encoded by tiktoken, from the same file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, special = told["model"], {t["id"] for t in told.get("added_tokens", [])}
        # The printable stand-ins for bytes: those that print stand for themselves, the others are moved behind 255.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        entries = [b""] * self.tokenizer.get_vocab_size()
        for token, i in model["vocab"].items():
            entries[i] = token.encode() if i in special else bytes(byte[c] for c in token)
        ranks = {b: i for i, b in enumerate(entries) if b and i not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.fast = None
        if told["pre_tokenizer"].get("use_regex", True) and merged == sorted(merged):
            pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.array([b.startswith(b" ") for b in entries])
        self.bytes, self.size, self.told = _tables(entries)

    def whole(self, texts: list[str], ahead: str = " ") -> list[list[int]]:
        """The ids of each text behind a space, or what else is put ahead."""
        out: list[list[int]] = []
        for t in texts:
            if self.fast is None or len(t) >= LONG and _LONG.search(t):
                out.append(self._slow(ahead + t))
            else:
                out.append(self.fast.encode_ordinary(ahead + t))
        return out

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, each behind a space, and how many each has; no word holds a space.

        Most are encoded as one string, whose tokens are told apart by the spaces that they start with."""
        odd = [i for i, w in enumerate(words) if not 0 < len(w) < LONG or w != w.strip()]
        of = np.delete(np.arange(len(words)), odd)
        joined = " " + " ".join(np.array(words, object)[of].tolist() if odd else words)  # without a long run, as no word has one or ends in white space
        ids = np.array((self.fast.encode_ordinary(joined) if self.fast else self._slow(joined)) if len(of) else [], np.int64)
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(of):  # not a vocabulary of this kind after all
            return flat(self.whole(words))
        counts = np.diff(np.append(starts, len(ids)))
        if not odd:
            return ids, counts
        more, n = flat(self.whole([words[i] for i in odd]))
        counts, place = np.concatenate([counts, n]), np.argsort(np.concatenate([of, odd]))
        return np.concatenate([ids, more])[spread(place, counts)[0]], counts[place]


class Pieces:
    """A model file of sentencepiece, which puts a space before a text by itself. fallback: ids that stand for one byte."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.fallback = np.array([self.model.is_byte(i) for i in range(n)])
        piece = lambda i: self.model.id_to_piece(i)
        self.bytes, self.size, self.told = _tables([bytes([int(piece(i)[3:5], 16)]) if self.fallback[i] else piece(i).replace("▁", " ").encode() for i in range(n)])

    def whole(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat(self.whole(words))


def _tables(entries: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of each id its bytes, how many these are, and its decimal."""
    return pa.array(entries, pa.binary()), np.array([len(b) for b in entries], np.int64), np.array([str(i) for i in range(len(entries))], object)


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum())), counts


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int, rows: int = 32_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about size bytes of a text column, and at most so many rows: what is encoded together
    depends on neither the session's batches nor how long texts are. A longer text is a batch by itself."""
    held: list[pa.RecordBatch] = []
    bytes_, n = 0, 0
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).tolist()
        at = 0
        for i, x in enumerate(sizes):
            if n and (bytes_ + x > size or n == rows):
                yield _joined([*held, b.slice(at, i - at)])
                held, bytes_, n, at = [], 0, 0, i
            bytes_, n = bytes_ + x, n + 1
        held.append(b.slice(at))
    if n:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


class Words:
    """The different words of texts, as they stand between single spaces, and the texts as numbers of these.

    Both kinds of vocabulary start a token at a space that stands alone, and none has a token that goes on behind one;
    so a text is the tokens of its words, each behind a space. A text in which a space doesn't stand alone is one word;
    an empty one has none. texts: without nulls. plain, wholes: the units, words and then such texts. text, unit: the text and the word of every place, in order.
    """

    def __init__(self, texts: pa.Array):
        crowded = pc.match_substring_regex(texts, CROWDED).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~crowded & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
        split = pc.split_pattern(texts.take(pa.array(plain)), " ")
        lengths = np.diff(np.asarray(split.offsets))
        numbered = split.flatten().dictionary_encode()
        self.plain = numbered.dictionary.to_pylist()
        self.text = np.repeat(plain, lengths)
        self.unit = numbered.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.wholes: list[str] = []
        self._add(texts, np.flatnonzero(crowded))

    def _add(self, texts: pa.Array, rows: np.ndarray) -> None:
        first = len(self.plain) + len(self.wholes)
        self.wholes += texts.take(pa.array(rows)).to_pylist()
        text, unit = np.concatenate([self.text, rows]), np.concatenate([self.unit, first + np.arange(len(rows))])
        order = np.argsort(text, kind="stable")
        self.text, self.unit = text[order], unit[order]

    def as_wholes(self, texts: pa.Array, rows: np.ndarray) -> None:
        """From here on these texts are one word each."""
        left = ~np.isin(self.text, rows)
        self.text, self.unit = self.text[left], self.unit[left]
        self._add(texts, rows)

    def encode(self, by: BytePairs | Pieces) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, and how many each has."""
        words, wholes = by.words(self.plain), flat(by.whole(self.wholes))
        return np.concatenate([words[0], wholes[0]]), np.concatenate([words[1], wholes[1]])


def spread(of: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that take the groups of in turn, of so many members each: each member's place among all, and the row that takes it."""
    own = counts[of]
    row = np.repeat(np.arange(len(of)), own)
    ends = np.cumsum(own)
    within = np.arange(len(row)) - np.repeat(ends - own, own)
    return (np.cumsum(counts) - counts)[of][row] + within, row

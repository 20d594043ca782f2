"""URL filters over a sorted array of 64-bit digests that workers map into memory."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spindrift.llm.shared import fresh, scratch_root


@dataclass(frozen=True)
class Rule:
    """Fits host and its subdomains if the path starts with path; verdict: allow or block."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Rule bytes that may be sent to every executor.
MOST_BYTES = 1 << 30


def packed(rules: Iterable[Rule]) -> bytes:
    """A file of: its header's length, a JSON header, the sorted keys, and for each key the end of its string and the
    verdict, then the strings. Of rules of the same host and path, block wins. A rule without a host or of another
    verdict than allow and block is an error."""
    table: dict[tuple[str, str], str] = {}
    for r in rules:
        if not r.host or r.verdict not in ("allow", "block"):
            raise ValueError(f"no rule: {r}")
        k = (r.host.lower(), r.path)
        table[k] = "block" if table.get(k) == "block" else r.verdict
    # host and path are told apart by a character that neither holds, so that they can't run into each other.
    rows = sorted((xxhash.xxh64_intdigest(f"{h}\n{p}".encode()), f"{h}\n{p}".encode(), v == "block") for (h, p), v in table.items())
    strings = [s for _, s, _ in rows]
    header = json.dumps({"n": len(rows), "lengths": sorted({len(p) for _, p in table}), "labels": sorted({h.count(".") + 1 for h, _ in table})}).encode()
    header += b" " * (-(len(header) + 8) % 8)
    out = b"".join([len(header).to_bytes(8, "little"), header, np.array([k for k, _, _ in rows], "<u8").tobytes(), np.cumsum([0, *map(len, strings)], dtype="<u8").tobytes(), np.array([b for *_, b in rows], "u1").tobytes(), *strings])
    if len(out) > MOST_BYTES:
        raise ValueError(f"{len(out)} bytes of rules; {MOST_BYTES} may be sent to every executor")
    return out


class Array:
    """The file, mapped: keys are probed by binary search, and a hit counts once its stored string is equal."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(raw[:8].tobytes(), "little")
        header = json.loads(raw[8 : 8 + size].tobytes())
        n, at = header["n"], 8 + size
        self.lengths, self.labels, self.keys = header["lengths"], header["labels"], raw[at : at + 8 * n].view("<u8")
        self.ends = raw[at + 8 * n : at + 8 * (2 * n + 1)].view("<u8")
        at += 8 * (2 * n + 1)
        self.block, self.strings = raw[at : at + n], raw[at + n :]

    def find(self, probes: list[bytes]) -> np.ndarray:
        """The position of each probe's rule, or -1."""
        out = np.full(len(probes), -1, np.int64)
        if not len(self.keys) or not probes:
            return out
        digests = np.array([xxhash.xxh64_intdigest(p) for p in probes], np.uint64)
        at = np.searchsorted(self.keys, digests)
        todo = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests))
        while len(todo):  # equal keys of different strings stand side by side
            for i in todo:
                j = at[i]
                if self.strings[self.ends[j] : self.ends[j + 1]].tobytes() == probes[i]:
                    out[i] = j
            todo = todo[out[todo] < 0]
            at[todo] += 1
            todo = todo[at[todo] < len(self.keys)]
            todo = todo[self.keys[at[todo]] == digests[todo]]
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, bool]]:
        """The longest rule that fits each (host, path), and whether it blocks; of equal length, the longer host's.

        A host is probed by its last labels, as many as some rule has, and a path by its first characters, as many as some
        rule has: so a long url makes no more probes than the rules have lengths.
        """
        probes, owners, lengths = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            labels = host.rsplit(".", self.labels[-1]) if self.labels else []
            tails = [".".join(labels[-k:]) for k in self.labels if k < len(labels) or k == host.count(".") + 1]
            for size in self.lengths:
                if size > len(path):
                    break
                for tail in tails:
                    probes.append(f"{tail}\n{path[:size]}".encode())
                    owners.append(i)
                    lengths.append((len(tail) + size, len(tail)))
        best: dict[int, tuple[tuple[int, int], int]] = {}
        for k, j in enumerate(self.find(probes).tolist()):
            if j >= 0 and (owners[k] not in best or lengths[k] > best[owners[k]][0]):
                best[owners[k]] = (lengths[k], j)
        out: list[tuple[str | None, bool]] = [(None, False)] * len(hosts)
        for i, (_, j) in best.items():
            out[i] = (self.strings[self.ends[j] : self.ends[j + 1]].tobytes().decode().replace("\n", "", 1), bool(self.block[j]))
        return out


def published(spark: SparkSession, rules: Iterable[Rule]) -> str:
    """The rules' file in the shared folder, from where Spark hands it to each executor, later ones included; its name there."""
    raw = packed(rules)
    name = f"url-rules-{xxhash.xxh3_128_hexdigest(raw)}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{name}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{os.getpid()}.part")
        out = fs.create(part, True)
        for i in range(0, len(raw), 1 << 20):
            out.write(bytearray(raw[i : i + (1 << 20)]))
        out.close()
        fs.rename(part, path)
    spark.sparkContext.addFile(path.toString())
    return name


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty where url is null or has no ://."""
    host = F.regexp_extract(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), r"(?s)^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty where url is null or has no ://."""
    return F.coalesce(F.regexp_extract(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(df: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """df with host, path, rule and verdict (replacing columns of these names).

    A narrow transformation; the rules go to executors as one file of a checked size. Where no rule fits (a null url and
    one without :// included), rule is null and verdict default. An empty table gives an empty one, no rules leave
    all to default; repeated rows are judged alike. Hosts with a port or user information are taken as they stand.
    """
    name, made = published(df.sparkSession, rules), ["host", "path", "rule", "verdict"]
    kept = df.drop(*made)
    ready = df.select(*[df[c] for c in kept.columns], host_of(df[url]).alias(fresh(df, "_host")), path_of(df[url]).alias(fresh(df, "_path")))
    schema = StructType([*kept.schema.fields, *[StructField(n, StringType()) for n in made]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = Array(SparkFiles.get(name))
        for b in batches:
            found = array.judge(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist())
            rule = pa.array([r for r, _ in found], pa.string())
            verdict = pa.array([default if r is None else "block" if x else "allow" for r, x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, rule, verdict], names=schema.names)

    return ready.mapInArrow(run, schema)

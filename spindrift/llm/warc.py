"""WARC archives: written as text with the records' own end as line end, and read back by verified chains of records.

Reading never trusts a magic by itself, as payloads may hold one. Each task takes a byte range, lists what may be a
record with the offset where its successor would start, and follows these pointers as far as its range goes. Between
ranges, pointer jumping from each file's start keeps what the chain reaches, in as many rounds as the logarithm of a
file's ranges; all else was inside a payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindrift.llm.shared import cut, small, stored

MAGIC = b"WARC/1."
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The longest header that is looked for.
MOST_HEADER = 1 << 16


def base32(digest: Column) -> Column:
    """A SHA-1 in hexadecimal as upper-case base32: five bytes at a time are eight digits, whose alphabet is changed."""
    digits = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*digits)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisits(rows: DataFrame) -> DataFrame:
    """Of rows(key, digest): (key, digest, first) of each whose payload a record of a larger key has, first being the largest.

    A hot digest is counted before the shuffle and joined in slim rows. Rows of the largest key are no revisits, however often it is repeated.
    """
    same = cut(rows.groupBy("digest").agg(F.max("key").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n"))
    return rows.join(small(same, same.count()), "digest").filter("key IS NULL OR key < first").select("key", "digest", "first").distinct()


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """A record a row at path, a file a partition: response, or revisit of the largest key of an equal payload.

    payload may be a string or binary; null is empty. Null keys and urls are written empty. Bytes of a url that can't
    stand in a header line, and a magic in it, are percent-encoded (white space and control characters all as %20).
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    full = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("body"))
    digest = base32(F.sha1(F.col("body"))).alias("digest")
    again = cut(revisits(full.select("key", digest)))
    again = small(again, again.count()).select(F.col("key").alias("_k"), F.col("digest").alias("_d"), "first")
    made = full.select("key", "url", "body", digest)
    made = made.join(again, made["key"].eqNullSafe(F.col("_k")) & (made["digest"] == F.col("_d")), "left")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:x-record:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("body").cast("string"), F.lit(END))
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20"), "WARC/", "%57ARC/")
    revisit = F.col("_d").isNotNull()
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body").cast("string")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", urn("key")), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn("first")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    )
    made.select(record.alias("value")).write.option("lineSep", END).text(path)


_FIELD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*$")


def _fields(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.split(b"\r\n")[1:]:
        if m := _FIELD.match(line):
            out.setdefault(m[1].decode("latin-1").lower(), m[2].decode("utf-8", "replace"))
    return out


def _payload(block: bytes, media: str) -> tuple[bytes, dict[str, str]]:
    """What follows the HTTP headers, if the block is an HTTP message, and these headers."""
    if media.lower().startswith("application/http"):
        head, found, body = block.partition(b"\r\n\r\n")
        return (body, _fields(head)) if found else (b"", {})
    return block, {}


def _described(fields: dict[str, str], block: bytes) -> tuple:
    body, http = _payload(block, fields.get("content-type", ""))
    return len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), http.get("content-length")


_RECORD = "type string, record_id string, target_uri string, refers_to string, stated_digest string, payload_bytes long, payload_digest string, stated_bytes string"
_CANDIDATE = f"file string, size long, block long, used long, off long, next long, exit long, whole boolean, {_RECORD}"
_NAMES = [x.split()[0] for x in _CANDIDATE.split(", ")]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over pieces between magics (file, size, block, bytes) in a range's order: its candidates, with offsets from the
    range's first piece, and a row with off null that tells how many bytes its pieces and their magics take."""
    now, rows, at, waiting = None, [], 0, []

    def closed() -> pa.RecordBatch:
        file, size, block = now
        offs = np.array([r[0] for r in rows], np.int64)
        ends = np.array([r[1] for r in rows], np.int64)
        # Each pointer jumps to its successor's pointer until all of them leave the range.
        here = np.arange(len(offs))
        place = np.minimum(np.searchsorted(offs, ends), max(0, len(offs) - 1))
        jump = np.where(offs[place] == ends, place, here) if len(offs) else here
        while (jump[jump] != jump).any():
            jump = jump[jump]
        exits = ends[jump]
        data = [[file, size, block, at, None, None, None, None, *[None] * 8]]
        data += [[file, size, block, at, r[0], r[1], int(e), *r[2:]] for r, e in zip(rows, exits.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*data, strict=True), _TYPES, strict=True)], names=_NAMES)

    def finish(force: bool) -> None:
        """Describes what waits at the front: candidates whose header or payload goes on behind a magic of their own range."""
        while waiting:
            off, raw, parts = waiting[0]
            have = raw + b"".join(MAGIC + p for p in parts)
            cut_at = have.find(b"\r\n\r\n")
            if cut_at < 0:
                if not force and len(have) < MOST_HEADER:
                    return
                waiting.pop(0)
                continue
            fields = _fields(have[:cut_at])
            length = fields.get("content-length", "")
            if not length.isascii() or not length.isdigit() or "warc-type" not in fields:
                waiting.pop(0)
                continue
            start, n = cut_at + 4, int(length)
            whole = len(have) >= start + n
            if not whole and not force and n <= MOST_HEADER:
                return
            told = _described(fields, have[start : start + n]) if whole else (None, None, None)
            rows.append((off, off + len(MAGIC) + start + n + 4, whole, fields["warc-type"].lower(), fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, *told))
            waiting.pop(0)

    for b in batches:
        files, sizes, blocks = (b.column(i).to_pylist() for i in range(3))
        for file, size, block, piece in zip(files, sizes, blocks, b.column(3), strict=True):
            if now != (file, size, block):
                if now:
                    finish(True)
                    yield closed()
                now, rows, at, waiting = (file, size, block), [], 0, []
                first = block == 0  # only there does the first piece follow no magic
            raw = piece.as_py()
            if waiting:
                for w in waiting:
                    w[2].append(raw)
                finish(False)
            if not first and raw[:3] in (b"0\r\n", b"1\r\n"):
                waiting.append((at - len(MAGIC), raw, []))
                finish(False)
            first = False
            at += len(raw) + len(MAGIC)
    if now:
        finish(True)
        yield closed()


_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_TYPES = [_KINDS[x.split()[1]] for x in _CANDIDATE.split(", ")]


def _walk(group: pa.Table) -> pa.Table:
    """The candidates of one range that its entries lead to."""
    offs, ends, entry = (group[c].to_numpy(zero_copy_only=False) for c in ("off", "next", "entry"))
    order = np.argsort(offs, kind="stable")
    offs, ends = offs[order], ends[order]
    reached = entry[order].astype(bool)
    at = np.searchsorted(offs, ends)
    hit = (at < len(offs)) & (offs[np.minimum(at, len(offs) - 1)] == ends)
    for i in range(len(offs)):  # successors stand behind, so that one turn is enough
        if reached[i] and hit[i]:
            reached[at[i]] = True
    return group.drop_columns(["entry"]).take(pa.array(order[reached]))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", MAGIC.decode()).text(path).select(meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("raw"))


def _based(ranges: DataFrame) -> DataFrame:
    """Of ranges(file, size, block, used): (file, block, base), where the range's first piece starts in the file."""
    over = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "block", F.coalesce(F.sum("used").over(over), F.lit(0)).alias("base"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives at path, plain or of gzip members (.gz, each read by one task), one row each: file, offset, length, type, record_id, target_uri,
    refers_to, stated_digest, payload_bytes, payload_digest (base32 SHA-1 of the payload there) and stated_bytes (HTTP's
    Content-Length).

    Offsets of a packed archive count its unpacked bytes. An archive whose chain doesn't end at its last byte is an error.
    An empty folder has no records.
    """
    if not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise FileNotFoundError(path)
    found = stored(_pieces(spark, path).mapInArrow(_scan, _CANDIDATE), "warc-candidates", 1000)
    ranges = cut(_based(found.filter("off IS NULL")))
    n = ranges.count()
    c = found.filter("off IS NOT NULL").join(small(ranges, n), ["file", "block"])
    c = c.withColumns({x: F.col(x) + F.col("base") for x in ("off", "next", "exit")}).drop("base", "used")
    # Only where another range's chain may enter does the walk between ranges have nodes.
    nodes = c.select("file", "off", "exit")
    doors = nodes.select("file", F.col("exit").alias("off")).union(nodes.select("file", F.lit(0).cast("long").alias("off"))).distinct()
    jump = cut(nodes.join(doors, ["file", "off"]).select("file", "off", F.col("exit").alias("to")))
    reached = cut(jump.filter("off = 0").select("file", "off"))
    most = ranges.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(1, int(most)).bit_length()):
        on = jump.select(F.col("file").alias("f"), F.col("off").alias("o"), F.col("to").alias("far"))
        step = reached.join(jump, ["file", "off"]).select("file", F.col("to").alias("off"))
        reached = cut(reached.union(step).distinct())
        jump = cut(jump.join(on, (jump["file"] == on["f"]) & (jump["to"] == on["o"])).select("file", "off", F.col("far").alias("to")))
    doors = reached.withColumn("entry", F.lit(True))
    flagged = c.join(small(doors, doors.count()), ["file", "off"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    kept = flagged.select("file", "block", "size", "off", "next", "whole", *_NAMES[8:], "entry")
    records = stored(kept.groupBy("file", "block").applyInArrow(_walk, kept.drop("entry").schema), "warc-records")
    # Of a packed file the pieces and their magics tell the size; behind the last piece there is no magic.
    unpacked = F.when(F.col("file").endswith(".gz"), F.sum("used") - len(MAGIC)).otherwise(F.max("size"))
    sizes = found.filter("off IS NULL").groupBy("file").agg(unpacked.alias("size"))
    torn = sizes.join(records.groupBy("file").agg(F.max("next").alias("end")), "file", "left").filter("size > 0 AND (end IS NULL OR end <> size)").first()
    if torn:
        raise ValueError(f"the chain of records in {torn['file']} ends at {torn['end']} of {torn['size']} bytes")
    names = ["file", F.col("off").alias("offset"), (F.col("next") - F.col("off")).alias("length"), *_NAMES[8:]]
    whole = records.filter("whole").select(*names)
    rest = records.filter("NOT whole")
    broken = rest.count()
    if not broken:
        return whole
    # Payloads with a magic inside: their pieces are brought together, a record at a time.
    numbered = _pieces(spark, path).mapInArrow(_numbered, "file string, block long, at long, raw binary").join(small(ranges, n), ["file", "block"])
    numbered = numbered.select("file", (F.col("at") + F.col("base")).alias("at"), "raw")
    held = small(rest.select(F.col("file").alias("f"), "off", "next"), broken)
    met = numbered.join(held, (numbered["file"] == held["f"]) & (F.col("at") >= F.col("off")) & (F.col("at") < F.col("next")))
    told = met.select("file", "off", "at", "raw").groupBy("file", "off").applyInArrow(_joined, "file string, off long, payload_bytes long, payload_digest string, stated_bytes string")
    return whole.union(rest.drop(*_NAMES[-3:]).join(told, ["file", "off"]).select(*names))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with where they start from the range's first one."""
    now, at = None, 0
    for b in batches:
        starts = []
        for file, block, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
            if now != (file, block):
                now, at = (file, block), 0
            starts.append(at)
            at += len(raw.as_buffer()) + len(MAGIC)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(starts, pa.int64()), b.column(3)], names=["file", "block", "at", "raw"])


def _joined(group: pa.Table) -> pa.Table:
    """What is told of the payload of one record, of all its pieces."""
    rows = sorted(zip(group["at"].to_pylist(), group["raw"].to_pylist(), strict=True))
    raw = MAGIC.join(r for _, r in rows)
    cut_at = raw.find(b"\r\n\r\n")
    fields = _fields(raw[:cut_at])
    told = _described(fields, raw[cut_at + 4 : cut_at + 4 + int(fields["content-length"])])
    return group.select(["file", "off"]).slice(0, 1).append_column("payload_bytes", pa.array([told[0]], pa.int64())).append_column("payload_digest", pa.array([told[1]])).append_column("stated_bytes", pa.array([told[2]], pa.string()))

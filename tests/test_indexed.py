"""Records with an index, read by ranges and looked up by title."""

import json
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindrift.sources import indexed
from spindrift.sources.dump import read_index, read_page, read_slices
from spindrift.sources.sinks import title_hash, write_indexed


def names(folder):
    return sorted(f.name for f in folder.iterdir()) if folder.exists() else []


@pytest.mark.parametrize("task_bytes", [1, 40, 333, 10_000])
def test_ranges_of_any_size_give_each_record_once(spark, tmp_path, task_bytes):
    rows = [(f"Title {i}: é", ("é" if i % 3 else "line\nline ") * (i * 7 % 40)) for i in range(200)] + [("", ""), ("twice", "1"), ("twice", "2")]
    write_indexed(spark.createDataFrame(rows, "title string, record string"), str(tmp_path / "d"), str(tmp_path / "i"), files=3)
    found = read_slices(spark, str(tmp_path / "d"), str(tmp_path / "i"), task_bytes)
    assert sorted(map(tuple, found.collect())) == sorted((t, r.removesuffix("\n")) for t, r in rows)
    assert found.rdd.getNumPartitions() >= (3 if task_bytes > 9000 else 20)


def test_a_failed_write_leaves_nothing_and_a_second_one_is_refused(spark, tmp_path):
    d, i = tmp_path / "d", tmp_path / "i"
    broken = spark.range(100, numPartitions=4).select(F.concat(F.lit("T"), "id").alias("title"), F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise("r").alias("record"))
    with pytest.raises(Exception, match="broken"):
        write_indexed(broken, str(d), str(i))
    assert names(d) == names(i) == []
    good = spark.createDataFrame([("a", "1")], "title string, record string").coalesce(1)
    write_indexed(good, str(d), str(i))
    assert names(d) == ["part-00000"] and (i / "part-00000").read_text() == "0: a\n"
    with pytest.raises(FileExistsError):
        write_indexed(good, str(d), str(i))


def test_only_attempts_that_counted_are_kept(tmp_path, monkeypatch):
    """Two attempts of one partition, of which the first was lost after it had written."""
    monkeypatch.setattr(indexed.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})()))
    writer = indexed.RecordWriter({"path": str(tmp_path / "d"), "index": str(tmp_path / "i")})
    batch = lambda r: iter([pa.RecordBatch.from_arrays([pa.array(["t"]), pa.array([r])], names=["title", "record"])])
    writer.write(batch("lost"))
    writer.commit([writer.write(batch("kept")), None])
    assert names(tmp_path / "d") == names(tmp_path / "i") == ["part-00003"]
    assert (tmp_path / "d" / "part-00003").read_text() == "kept\n"
    writer.write(batch("aborted"))
    writer.abort([])
    assert names(tmp_path / "d") == ["part-00003"]


def test_tables_without_rows(spark, tmp_path):
    write_indexed(spark.createDataFrame([], "title string, record string"), str(tmp_path / "d"), str(tmp_path / "i"))
    assert read_slices(spark, str(tmp_path / "d"), str(tmp_path / "i")).count() == 0
    assert read_index(spark, str(tmp_path / "i")).count() == 0
    assert read_page(spark, str(tmp_path / "d"), str(tmp_path / "i"), "x") is None


def hashed(spark, *titles):
    return [r[0] for r in spark.createDataFrame([(t,) for t in titles], "t string").select(title_hash(F.col("t"))).collect()]


def test_a_look_up_makes_as_many_reads_for_any_number_of_records(spark, tmp_path):
    reads = {}
    for n in (1000, 60_000):
        d, i = str(tmp_path / f"d{n}"), str(tmp_path / f"i{n}")
        rows = spark.range(n).select(F.concat(F.lit("Page "), "id").alias("title"), F.concat(F.lit("record "), "id").alias("record"))
        again = spark.range(900, numPartitions=1).select(F.lit("Often").alias("title"), F.concat(F.lit("copy "), "id").alias("record"))
        write_indexed(rows.union(again).coalesce(2), d, i)
        titles = [f"Page {k}" for k in range(0, n, n // 50)]
        reads[n] = []
        for title, h in zip(titles, hashed(spark, *titles), strict=True):
            table = indexed.Lookup(d, i)
            assert table.record(title, h) == title.replace("Page", "record")
            reads[n].append(table.reads)
        table = indexed.Lookup(d, i)
        assert table.record("Often", *hashed(spark, "Often")) == "copy 899" and table.reads == 5
        # Another title of the same hash is told apart in full.
        assert indexed.Lookup(d, i).record("Page 1x", hashed(spark, "Page 1")[0]) is None
        assert read_page(spark, d, i, "Page 7") == "record 7" and read_page(spark, d, i, "Page -7") is None
    assert max(reads[1000]) == max(reads[60_000]) == 5


_READS = """
import resource, sys
from spindrift.sources.indexed import RecordReader
reader = RecordReader({"path": sys.argv[1], "index": sys.argv[2], "range": str(1 << 40)})
parts = reader.partitions()
size = rows = 0
for b in reader.read(parts[0]):
    size, rows = size + b.column(1).nbytes, rows + b.num_rows
print(len(parts), rows, size >= 1000 * (1 << 20), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""


def test_a_file_of_a_gigabyte_is_read_in_little_memory(tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "i").mkdir()
    record = b"x" * ((1 << 20) - 1) + b"\n"
    with (tmp_path / "d" / "part-00000").open("wb") as f:
        for _ in range(1024):
            f.write(record)
    (tmp_path / "i" / "part-00000").write_text("".join(f"{k << 20}: T{k}\n" for k in range(1024)))
    out = subprocess.run([sys.executable, "-c", _READS, str(tmp_path / "d"), str(tmp_path / "i")], capture_output=True, text=True, check=True).stdout.split()
    (tmp_path / "d" / "part-00000").unlink()
    assert out[:3] == ["1", "1024", "True"]
    assert int(out[3]) < 400  # MB


def test_records_are_written_in_one_pass(spark, tmp_path):
    """One write makes data and index, of rows that are computed once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(500, numPartitions=3).select(F.concat(F.lit("T"), "id").alias("title"), F.to_json(F.struct("id")).alias("record"))
    write_indexed(rows.mapInArrow(count, "title string, record string"), str(tmp_path / "d"), str(tmp_path / "i"))
    assert seen.value == 500
    found = {r["title"]: json.loads(r["record"])["id"] for r in read_slices(spark, str(tmp_path / "d"), str(tmp_path / "i")).collect()}
    assert found == {f"T{k}": k for k in range(500)}

"""The same extraction over dumps that arrive in a folder: stateless, so exactly once with a file sink."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from spindrift.operators.extract import Extractor, extract
from spindrift.sources.dump import read_dump_stream


def run_extraction(spark: SparkSession, folder: str, out: str, checkpoint: str, extractor: str | Extractor = "links", once: bool = True) -> StreamingQuery:
    """Records of each new dump in folder as JSON lines in out; once: what is there now, in batches, then end."""
    records = extract(read_dump_stream(spark, folder), extractor)
    writer = records.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()

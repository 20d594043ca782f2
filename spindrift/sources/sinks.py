"""Writers of extracted records and of titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.operators.ordered import running_sum
from spindrift.sources import indexed
from spindrift.sources.dump import index_lines, title_hash


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_titles(df: DataFrame, path: str, column: str = "title") -> None:
    """A title a line, in no order."""
    df.select(F.col(column).cast("string").alias("value")).write.text(path)


def offsets(records: DataFrame, size: Column, part: list[str], order: list[str]) -> DataFrame:
    """records with start_offset and end_offset: the bytes of the records of the same part that come before, and the same with the record itself."""
    placed = running_sum(records.withColumn("_size", size), F.col("_size"), part, order, "start_offset")
    return placed.withColumn("start_offset", F.col("start_offset").cast("long")).withColumn("end_offset", (F.col("start_offset") + F.col("_size")).cast("long")).drop("_size")


def write_indexed(records: DataFrame, data_path: str, index_path: str, files: int | None = None) -> None:
    """records(title, record) as data files of a record a line, index files of lines `offset: title`, and a table by which a title is looked up.

    A partition is a file, so files are as large as the input's splits, or as many as files says. A task writes both files
    as its records go by: records are made and written once, without a shuffle or a sort. Attempts write to folders of
    their own, and the commit moves those that counted; failed ones leave nothing. Data and index have files of one name.
    The look-up table is sorted by a hash of the title, from the index alone.
    """
    spark = records.sparkSession
    indexed.register(spark)
    data, index = indexed.qualified(spark, data_path), indexed.qualified(spark, index_path)
    for path in (data, index):
        if indexed.files(path):
            raise FileExistsError(f"{path} has files already")
    rows = records.select(F.coalesce("title", F.lit("")).alias("title"), F.coalesce("record", F.lit("")).alias("record"))
    rows = rows.repartition(files) if files else rows
    rows.write.format(indexed.RECORDS).options(path=data, index=index).mode("append").save()
    write_lookup(spark, data, index)


def write_lookup(spark: SparkSession, data_path: str, index_path: str) -> None:
    """The look-up table of index files: a row of 40 bytes a record, dealt by ranges of the title's hash."""
    indexed.register(spark)
    data, index = indexed.qualified(spark, data_path), indexed.qualified(spark, index_path)
    sizes = spark.createDataFrame([(str(indexed.number(f.base_name)), f.size) for f in indexed.files(data)], "file string, size long")
    rows = index_lines(spark, index).join(sizes, "file")
    end = F.coalesce("end_offset", "size")
    rows = rows.select(title_hash(F.col("title")).alias("hash"), F.col("file").cast("long").alias("file"), F.col("start_offset").alias("start"), end.alias("end"), F.col("line_offset").alias("line"))
    order = ["hash", "file", "start"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.format(indexed.LOOKUP).option("path", f"{index}/_lookup").mode("append").save()


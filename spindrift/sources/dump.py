"""XML dumps as pages, and the index files that go with extracted data."""

from __future__ import annotations

import re
import urllib.request
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from spindrift.sources import indexed

#: What is read of a page; all else in the file is skipped.
PAGE_XML = StructType(
    [
        StructField("title", StringType()),
        StructField("redirect", StructType([StructField("_title", StringType())])),
        StructField("revision", ArrayType(StructType([StructField("text", StructType([StructField("_VALUE", StringType())]))]))),
    ]
)
XML_OPTIONS = {"rowTag": "page", "ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}

# Title prefixes of pages that aren't articles.
META_PREFIXES = ["Wikipedia", "Portal", "File", "Template", "Category", "Draft", "Module", "MediaWiki", "Help"]
DISAMBIGUATION = "(disambiguation)"

PAGE_LINKS = "title string, links array<struct<target:string,label:string>>"


def is_article(title: Column) -> Column:
    """Neither a meta page, by the case-sensitive prefix, nor a disambiguation page, by the end in any case."""
    meta = title.startswith(f"{META_PREFIXES[0]}:")
    for prefix in META_PREFIXES[1:]:
        meta = meta | title.startswith(f"{prefix}:")
    return ~meta & ~F.lower(title).endswith(DISAMBIGUATION)


def articles(pages: DataFrame) -> DataFrame:
    """Pages(title, redirect, ...) without redirects, meta and disambiguation pages. Filters stand before any extraction."""
    kept = pages.filter(F.col("redirect").isNull()) if "redirect" in pages.columns else pages
    return kept.filter(is_article(F.col("title")))


def _projected(raw: DataFrame) -> DataFrame:
    """A page without a title, or with an empty one, is an error, but for a redirect."""
    text = F.coalesce(F.try_element_at("revision", F.lit(-1))["text"]["_VALUE"], F.lit(""))
    named = (F.coalesce("title", F.lit("")) != "") | F.col("redirect").isNotNull()
    title = F.when(named, F.col("title")).otherwise(F.raise_error(F.lit("a page has no title")))
    return raw.select(title.alias("title"), "redirect", text.alias("text"))


class DumpError(ValueError):
    """A dump that is not one, or a page in it that is broken: the message says where."""


def check_root(spark: SparkSession, path: str) -> None:
    """DumpError where a file's first element isn't mediawiki. Of each file the head is read, unpacked by its ending as Spark does."""
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    fs = found.getFileSystem(hadoop)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop)
    for at in fs.globStatus(found) or []:
        for status in fs.listStatus(at.getPath()) if at.isDirectory() else [at]:
            if status.isDirectory() or status.getPath().getName()[0] in "_." or not status.getLen():
                continue
            stream = fs.open(status.getPath())
            try:
                codec = codecs.getCodec(status.getPath())
                head = bytes((codec.createInputStream(stream) if codec else stream).readNBytes(_HEAD))
            finally:
                stream.close()
            root = _ROOT.match(head)
            if not root or root[1] != b"mediawiki":
                raise DumpError(f"{status.getPath().toString()}: the root is {root[1].decode('utf-8', 'replace') if root else 'missing'}, not mediawiki")


#: Bytes in which a file's root begins, and what may stand before it: a byte order mark, declarations, comments.
_HEAD = 4096
_ROOT = re.compile(rb"(?:\xef\xbb\xbf)?(?:\s|<\?.*?\?>|<!--.*?-->|<![A-Za-z][^>]*>)*<([^\s/>!?]+)", re.DOTALL)


_END = "</page>"


def _pieces(spark: SparkSession, path: str, *cols: Column) -> DataFrame:
    """(cols, value, lead, begins, page): a file's text in pieces that end with a page, read split by split; begins: a page
    begins in the piece; lead: what stands before it; page: its text with its end."""
    pieces = spark.read.option("lineSep", _END).text(path).select(*cols, "value")
    found = pieces.withColumn("lead", F.regexp_extract("value", r"(?s)^(.*?)<page[\s>]", 1)).withColumn("begins", F.col("value").rlike(r"<page[\s>]"))
    return found.withColumn("page", F.concat(F.expr("substr(value, length(lead) + 1)"), F.lit(_END)))


def broken_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, page): pages that can't be parsed, with the byte at which each begins in its file (unpacked), and the text that was read as it.

    The file is read in pieces that end with a page, split by split; the bytes before a piece are summed within its
    split, and over the splits in a table of one row a split. No text is shuffled but that of broken pages.
    """
    meta = F.col("_metadata")
    found = _pieces(spark, path, meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))
    page = F.col("page")
    schema = StructType([*PAGE_XML.fields, StructField("_broken", StringType())])
    read = F.from_xml(page, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "ignoreSurroundingSpaces": "false"})
    found = found.withColumn("page", F.when(F.col("begins") & read["_broken"].isNotNull(), page))
    found = found.select("file", "block", "row", (F.octet_length("value") + len(_END)).alias("size"), F.octet_length("lead").alias("lead"), "page")
    blocks = found.groupBy("file", "block").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    before = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).filter("page IS NOT NULL").join(blocks, ["file", "block"])
    return found.select("file", (F.col("base") + F.col("before") + F.col("lead")).alias("position"), "page")


@contextmanager
def located(spark: SparkSession, path: str) -> Iterator[None]:
    """Around an action on a dump's pages: where it fails for a broken page, DumpError with the first one's file and byte position.

    Only then the dump is read once more, to find them. Any other error goes on as it is."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as e:
        if not re.search(r"MALFORMED_RECORD|a page has no title", str(e)):
            raise
        if "a page has no title" in str(e):
            raise DumpError(f"{path}: a page has no title") from e
        first = broken_pages(spark, path).select("file", "position").orderBy("file", "position").first()
        raise DumpError(f"error at position {first['position']} of {first['file']}: the page that begins there is broken" if first else f"{path}: a page is broken") from e


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All pages of a dump (plain or compressed): title, redirect, and the last revision's text, empty if it has none.

    A file is read split by split, those packed by bzip2 too, in pieces that end with a page; Spark's own reader of XML
    takes a file as a whole. So no comment or CDATA section may hold a page's tags, which dumps escape: one that does is an error.

    A root other than mediawiki is a DumpError at once; a broken page, or one without a title, is an error of the action that comes to it, which located() explains."""
    check_root(spark, path)
    other = F.when(F.col("begins"), F.col("lead")).otherwise(F.col("value"))
    untitled = F.col("other").rlike(r"<page\s*/>")
    found = _pieces(spark, path).withColumn("other", other).filter(F.col("begins") | untitled)
    page = F.when(F.col("other").rlike(r"(?s)<!(?:--(?!.*?-->)|\[CDATA\[(?!.*?\]\]>))"), F.raise_error(F.lit("MALFORMED_RECORD: a comment holds a page")))
    page = page.when(untitled, F.raise_error(F.lit("a page has no title"))).otherwise(F.col("page"))
    read = F.from_xml(page, PAGE_XML, XML_OPTIONS)
    return _projected(found.select(F.inline(F.array(read))))  # a generator reads a page once, whatever is asked of it


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """The articles of a dump: title, text."""
    return articles(read_pages(spark, path)).select("title", "text")


def read_dump_stream(spark: SparkSession, path: str) -> DataFrame:
    """The articles of dumps as they arrive in a folder."""
    return articles(_projected(spark.readStream.format("xml").options(**XML_OPTIONS).schema(PAGE_XML).load(path))).select("title", "text")


def index_lines(spark: SparkSession, path: str) -> DataFrame:
    """An index's lines `offset: title` as (file, title, idx, start_offset, end_offset, line_offset), by file, so that files
    are independent. end_offset is the next record's start, null for a file's last; line_offset is where the line starts in
    the index. file is n for a file `part-n`, else its name.

    Lines of one split of a file meet in a window; what goes over from split to split comes from a table of one row a split.
    """
    meta = F.col("_metadata")
    digits = F.regexp_extract(meta["file_name"], r"^part-(\d+)$", 1)
    file = F.when(digits != "", digits.cast("long").cast("string")).otherwise(meta["file_name"])
    lines = spark.read.text(path).select(file.alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    told = F.regexp_extract("value", r"^\s*(\d+)\s*:", 1)
    rows = lines.select("file", "block", "row", told.try_cast("long").alias("start_offset"), F.regexp_extract("value", r"^[^:]*: ?(.*)$", 1).alias("title"), (F.octet_length("value") + 1).alias("size"))
    valid = F.col("start_offset").isNotNull()
    of_file = Window.partitionBy("file").orderBy("block")
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("file", "block").agg(F.count_if(valid).alias("n"), F.min("start_offset").alias("first"), F.sum("size").alias("bytes"))
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    behind = F.first("first", ignorenulls=True).over(of_file.rowsBetween(1, Window.unboundedFollowing))
    splits = splits.select("file", "block", before("n").alias("base"), before("bytes").alias("line_base"), behind.alias("next"))
    over = Window.partitionBy("file", "block").orderBy("row")
    to_here = over.rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("i", F.sum(valid.cast("int")).over(to_here)).withColumn("line", F.sum("size").over(to_here) - F.col("size"))
    found = found.filter(valid).withColumn("end", F.lead("start_offset").over(over)).join(splits, ["file", "block"])
    return found.select("file", "title", (F.col("base") + F.col("i") - 1).cast("long").alias("idx"), "start_offset", F.coalesce("end", "next").alias("end_offset"), (F.col("line_base") + F.col("line")).alias("line_offset"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, title, idx, start_offset, end_offset) of an index's lines, as index_lines() tells; titles without spaces around."""
    return index_lines(spark, path).withColumn("title", F.trim("title")).drop("line_offset")


def read_slices(spark: SparkSession, data_path: str, index_path: str, task_bytes: int = indexed.RANGE) -> DataFrame:
    """(title, record) of data files by the offsets of their indexes: each record is the bytes from its start to the next one's, less a line feed at its end.

    A task is a range of index lines, which lead to about task_bytes of a data file; it seeks there and reads in pieces,
    so it holds a few megabytes of records, however large files are.
    """
    indexed.register(spark)
    found = spark.read.format(indexed.RECORDS).options(path=indexed.qualified(spark, data_path), index=indexed.qualified(spark, index_path))
    return found.option("range", str(task_bytes)).load()


def title_hash(title: Column) -> Column:
    """By what look-up tables are sorted."""
    return F.xxhash64(title)


def read_page(spark: SparkSession, data_path: str, index_path: str, title: str) -> str | None:
    """The record of a title; None without one. Of records of one title the last counts.

    The look-up table is probed by seeks: a sparse index, a block of it, the line, the record: a number of reads that
    doesn't grow with the records."""
    hashed = spark.createDataFrame([(title,)], "title string").select(title_hash(F.col("title"))).first()[0]
    return indexed.Lookup(indexed.qualified(spark, data_path), indexed.qualified(spark, index_path)).record(title, hashed)


def page_record(value: Column) -> Column:
    """A record of extracted links from its JSON; anything else is an error."""
    return F.from_json(value, PAGE_LINKS, {"mode": "FAILFAST"})


def read_page_links(spark: SparkSession, path: str) -> DataFrame:
    """Extracted links, one JSON object a line."""
    return spark.read.schema(PAGE_LINKS).option("mode", "FAILFAST").json(path)


def fetch(spark: SparkSession, url: str, path: str, piece: int = 4 << 20) -> int:
    """Downloads a dump as it is to path in any file system that Spark knows, and gives its bytes. Spark reads a .bz2 in splits, so it isn't unpacked."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    fs, size = target.getFileSystem(spark._jsc.hadoopConfiguration()), 0
    with urllib.request.urlopen(url) as source:
        out = fs.create(part, True)
        while raw := source.read(piece):
            out.write(bytearray(raw))
            size += len(raw)
        out.close()
    fs.rename(part, target)
    return size


def find_page(pages: DataFrame, title: str) -> DataFrame:
    """The page of a title; the filter reaches the scan."""
    return pages.filter(F.col("title") == title)

"""Extractors, records, progress lines and the command line over the test tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.functions.progress import Progress, progress_line
from spindrift.operators import graph as g
from spindrift.operators.extract import extract, register_extractor, register_functions
from spindrift.plans import engine
from spindrift.plans.catalog import query
from spindrift.plans.graph_queries import spread, table
from spindrift.session import scratch
from spindrift.sources.dump import DumpError, broken_pages, located, page_record, read_dump
from spindrift.sources.sinks import write_titles

_NL = "chr(10)"


_WIDTH = 160


@query("xml_error", "SELECT c_custkey, CAST(strlen('<mediawiki>' || c_custkey) AS BIGINT) AS place, true AS located FROM customer WHERE c_custkey % 40 = 7")
def xml_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which an element isn't closed: where each begins in its line, as all lines are of one width, and whether an action on the dump's pages fails with the position of one of them."""
    path = scratch(spark, "broken")
    title = "CASE WHEN c_custkey % 40 = 7 THEN '<title>' || c_name ELSE '<title>' || c_name || '</title>' END"
    page = f"'<mediawiki>' || c_custkey || '<page>' || {title} || '<revision><text>' || c_custkey || '</text></revision></page></mediawiki>'"
    table(spark, sf_dir, "customer").select(F.expr(f"rpad({page}, {_WIDTH - 1}, ' ')").alias("value")).write.text(path)
    broken = broken_pages(spark, path)
    try:
        with located(spark, path):
            read_dump(spark, path).write.format("noop").mode("overwrite").save()
        told = "nothing"
    except DumpError as e:
        told = str(e)
    found = broken.select(F.regexp_extract("page", r"<text>(\d+)<", 1).cast("long").alias("c_custkey"), (F.col("position") % _WIDTH).alias("place"), F.concat(F.lit("error at position "), "position", F.lit(" of "), "file").alias("where"))
    one = found.filter(F.lit(told).startswith(F.col("where"))).count() == 1
    return found.select("c_custkey", "place", F.lit(one).alias("located"))


@query("page_decode", "SELECT c_custkey, c_name AS title, 2 AS n, 'T' || c_nationkey AS target, c_mktsegment AS label FROM customer")
def page_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages from their JSON records."""
    record = "'{\"title\":\"' || c_name || '\",\"links\":[{\"target\":\"T' || c_nationkey || '\",\"label\":\"' || c_mktsegment || '\"},{\"target\":\"\",\"label\":\"\"}]}'"
    found = table(spark, sf_dir, "customer").select("c_custkey", page_record(F.expr(record)).alias("r"))
    return found.select("c_custkey", "r.title", F.size("r.links").alias("n"), F.col("r.links")[0]["target"].alias("target"), F.col("r.links")[0]["label"].alias("label"))


def _articles(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spread(spark, sf_dir, "customer").select(F.col("c_name").alias("title"), F.expr(text).alias("text"))


@query("extract_links_records", "SELECT c_name AS title, '{\"title\":\"' || c_name || '\",\"links\":[{\"target\":\"A\",\"label\":\"' || c_mktsegment || '\"},{\"target\":\"' || c_custkey || '\",\"label\":\"' || c_custkey || '\"}]}' AS record FROM customer")
def extract_links_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extractor named links: a page's links as JSON."""
    return extract(_articles(spark, sf_dir, "'see [[A|' || c_mktsegment || ']] [[' || c_custkey || ']] [[open'"), "links")


_TREE = [
    "{", "  \"section_name\": \"@\",", "  \"text\": \"lead @\\n\",", "  \"children\": [", "    {", "      \"section_name\": \"H\",", "      \"text\": \"body\\n\",", "      \"children\": [",
    "        {", "          \"section_name\": \"I\",", "          \"text\": \"in\\n\",", "          \"children\": []", "        }", "      ]", "    },",
    "    {", "      \"section_name\": \"J\",", "      \"text\": \"end\\n\",", "      \"children\": []", "    }", "  ]", "}",
]


@query("extract_contents_records", f"SELECT c_name AS title, replace({f' || {_NL} || '.join(f"'{x}'" for x in _TREE)}, '@', c_name) AS record FROM customer")
def extract_contents_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extractor named contents: the plain text's sections as JSON, to the byte."""
    lines = ["'''lead''' [[x|@]]", "== H ==", "body<ref>r</ref>", "=== I ===", "in", "== Empty ==", "== J ==", "end", "== See also ==", "* x"]
    text = " || chr(10) || ".join("'" + x.replace("'", "\\'") + "'" for x in lines)
    return extract(_articles(spark, sf_dir, f"replace({text}, '@', c_name)"), "contents")


@query("extract_custom", "SELECT c_name AS title, CAST(length('see ' || c_mktsegment) AS INTEGER) AS n FROM customer")
def extract_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function of the caller's as the extractor."""
    return extract(_articles(spark, sf_dir, "'see ' || c_mktsegment"), lambda d: d.select("title", F.length("text").alias("n")))


def _headings(title: str, text: str | None) -> Iterator[tuple[int, str]]:
    """The second-level headings of an article, numbered."""
    found = re.findall(r"^==([^=].*?)==\s*$", text or "", re.MULTILINE)
    yield from ((i, h.strip()) for i, h in enumerate(found))


@query("extract_table_function", "SELECT c_name AS title, i AS n, CASE i WHEN 0 THEN c_mktsegment ELSE 'Nation ' || c_nationkey END AS heading, 'bold ' || c_custkey AS lead FROM customer, range(2) AS r(i) WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_name, 0, c_mktsegment, 'bold ' || c_custkey FROM customer WHERE c_custkey % 3 = 0")
def extract_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extractor of the caller's as a table function of SQL, beside plain text as a function."""
    register_extractor(spark, "headings", _headings, "n int, heading string")
    register_functions(spark)
    text = r"concat('\'\'\'bold\'\'\' ', c_custkey, '\n== ', c_mktsegment, ' ==\nx\n=== deeper ===\n', CASE WHEN c_custkey % 3 <> 0 THEN concat('== Nation ', c_nationkey, ' ==\ny') ELSE '' END)"
    _articles(spark, sf_dir, text).createOrReplaceTempView("spindrift_articles")
    return spark.sql("SELECT a.title, CAST(h.n AS BIGINT) AS n, h.heading, split_part(plain_text(a.text), '\n', 1) AS lead FROM spindrift_articles a, LATERAL headings(a.title, a.text) h")


@query("title_list", "SELECT c_name AS title FROM customer")
def title_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles written a line each, and read again."""
    path = scratch(spark, "titles")
    write_titles(table(spark, sf_dir, "customer"), path, "c_name")
    return spark.read.text(path).withColumnRenamed("value", "title")


@query("root_lookup", "SELECT max(c_name) AS title, max(c_custkey) AS idx, CAST(NULL AS VARCHAR) AS message FROM customer WHERE c_name = (SELECT max(c_name) FROM customer) UNION ALL SELECT 'No such page', NULL, 'no page is titled ''No such page'''")
def root_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of a root that there is, and what is told of one that there isn't."""
    index = g.page_index(table(spark, sf_dir, "customer").select(F.col("c_name").alias("title"), F.col("c_custkey").alias("idx")))
    rows = []
    for title in (index.agg(F.max("title")).first()[0], "No such page"):
        try:
            rows.append((title, g.root_of(index, title), None))
        except ValueError as e:
            rows.append((title, None, str(e)))
    return spark.createDataFrame(rows, "title string, idx long, message string")


_CLOCK = "printf('%02d:%02d', CAST({0} AS BIGINT) // 60, CAST({0} AS BIGINT) % 60)"
_LINE = f"printf('%.2f%% %.0f/%.0f | %.1f rows/s (%.1f rows/s) | ', 100 * done / total, done, total, rate, mean) || {_CLOCK.format('floor(CASE WHEN mean > 0 THEN (total - done) / mean ELSE 0 END)')} || printf(' (%s)', {_CLOCK.format('floor(CASE WHEN mean > 0 THEN total / mean ELSE 0 END)')})"


@query("progress_lines", f"WITH t AS (SELECT t, t * t * 10.0::DOUBLE AS done, (SELECT count(*) FROM customer) * 100.0::DOUBLE AS total, greatest(0, (t - 3) // 6 * 6) AS since FROM range(0, 22, 3) AS r(t)), m AS (SELECT *, CASE WHEN t > 0 THEN done / t ELSE 0 END AS mean, CASE WHEN t > since THEN (done - since * since * 10.0) / (t - since) ELSE 0 END AS rate FROM t) SELECT t AS second, {_LINE} AS line FROM m")
def progress_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one progress at every third second; the window of five seconds starts anew at every second of them."""
    p = Progress(100.0 * table(spark, sf_dir, "customer").count(), window=5)
    return spark.createDataFrame([(t, p.line(10.0 * t * t, float(t))) for t in range(0, 22, 3)], "second long, line string")


@query("progress_stateless", f"WITH t AS (SELECT k, count(*) * k / 4.0::DOUBLE AS done, count(*) * 1.0::DOUBLE AS total FROM customer, range(5) AS r(k) GROUP BY k), m AS (SELECT *, CASE WHEN k > 0 THEN done / (k * 7) ELSE 0 END AS mean, CASE WHEN k > 0 THEN done / (k * 7) ELSE 0 END AS rate FROM t) SELECT k, {_LINE} AS line FROM m")
def progress_stateless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be said at one moment, at every quarter of the way."""
    n = table(spark, sf_dir, "customer").count()
    return spark.createDataFrame([(k, progress_line(n * k / 4, n, 7.0 * k)) for k in range(5)], "k long, line string")


_CLI = "n AS (SELECT count(*) AS n FROM customer), e AS (SELECT a.c_custkey AS src, b.c_custkey AS dst FROM customer a, n JOIN customer b ON b.c_custkey = a.c_custkey * 7 % n + 1 OR b.c_custkey = a.c_custkey * 3 % n + 1)"


@query("command_line", f"WITH RECURSIVE {_CLI}, r(k, h) AS (SELECT (SELECT min(c_custkey) FROM customer), 0 UNION SELECT dst, h + 1 FROM r JOIN e ON k = src WHERE h < 4) SELECT DISTINCT 'P' || k AS title FROM r WHERE h > 0")
def command_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump, its links and a subgraph, all by the command line."""
    customers = table(spark, sf_dir, "customer")
    dump, data, index, out = (scratch(spark, x) for x in ("dump", "data", "index", "titles"))
    n, root = customers.agg(F.count("*"), F.min("c_custkey")).first()
    text = f"'[[P' || (c_custkey * 7 % {n} + 1) || ']] [[P' || (c_custkey * 3 % {n} + 1) || '|x]] [[Nowhere]]'"
    page = customers.select(F.expr("'P' || c_custkey").alias("title"), F.array(F.struct(F.struct(F.expr(text).alias("_VALUE"), F.lit("7").alias("_bytes")).alias("text"))).alias("revision"))
    page.write.format("xml").options(rowTag="page", rootTag="mediawiki", declaration="").save(dump)
    engine.main(["parse", "-i", dump, "--output-data", data, "--output-index", index, "-e", "links"])
    engine.main(["subgraph", "--input-data", data, "-r", f"P{root}", "-d", "4", "-m", "depth-limited", "-o", out])
    return spark.read.text(out).withColumnRenamed("value", "title")

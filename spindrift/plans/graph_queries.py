"""Links, the link graph, filters, scans and offsets over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.functions.namespaces import is_shortcut, namespace
from spindrift.operators import graph as g
from spindrift.operators.links import extract_links, page_links
from spindrift.plans.catalog import query
from spindrift.session import scratch
from spindrift.sources.dump import articles, find_page, read_dump, read_index, read_page, read_slices
from spindrift.sources.sinks import offsets, write_indexed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows go to Python or to files: dealt to as many tasks as a shuffle has, as a scan has no more than the file has row groups, often one."""
    return table(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


_LINK_TEXT = "concat('[[', n_name, '|', n_name, ' land|x]] [[', n_name, ']] [[F{{a|', n_name, '}}|z]] [[A}|b]] [[|]] [[]] [[[', n_name, ']]] [[open ', n_name)"


@query(
    "links_extract",
    """
    WITH e AS (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_custkey, pos, target, label FROM (
        SELECT c_custkey, 0 AS pos, n_name AS target, n_name || ' land|x' AS label FROM e UNION ALL
        SELECT c_custkey, 1, n_name, n_name FROM e UNION ALL SELECT c_custkey, 2, 'F{{a|' || n_name || '}}', 'z' FROM e UNION ALL
        SELECT c_custkey, 3, 'A}|b', 'A}|b' FROM e UNION ALL SELECT c_custkey, 4, '', '' FROM e UNION ALL SELECT c_custkey, 5, '', '' FROM e UNION ALL
        SELECT c_custkey, 6, '[' || n_name, '[' || n_name FROM e)
    """,
)
def links_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of a text for each customer, with its place."""
    text = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.expr(_LINK_TEXT).alias("text"))
    return text.select("c_custkey", F.posexplode(extract_links(F.col("text"))).alias("pos", "link")).select("c_custkey", "pos", "link.target", "link.label")


@query("links_from_html", "SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages")
def links_from_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same array and explode over the pages' anchors."""
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))


_TITLE = "CASE p_partkey % 12 WHEN 0 THEN 'Wikipedia:' WHEN 1 THEN 'Portal:' WHEN 2 THEN 'File:' WHEN 3 THEN 'Template:' WHEN 4 THEN 'Category:' WHEN 5 THEN 'Draft:' WHEN 6 THEN 'Module:' WHEN 7 THEN 'MediaWiki:' WHEN 8 THEN 'Help:' WHEN 9 THEN 'Talk:' WHEN 10 THEN 'wikipedia:' ELSE '' END || p_name || CASE p_size % 3 WHEN 0 THEN ' (Disambiguation)' WHEN 1 THEN ' (disambiguation) x' ELSE '' END"


@query("page_filter", f"WITH t AS (SELECT p_partkey, {_TITLE} AS title FROM part) SELECT p_partkey, title FROM t WHERE p_partkey % 7 <> 0 AND NOT regexp_matches(title, '^(Wikipedia|Portal|File|Template|Category|Draft|Module|MediaWiki|Help):') AND NOT ends_with(lower(title), '(disambiguation)')")
def page_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redirects, meta and disambiguation pages taken out."""
    redirect = F.when(F.col("p_partkey") % 7 == 0, F.struct(F.lit("x").alias("_title")))
    return articles(table(spark, sf_dir, "part").select("p_partkey", F.expr(_TITLE).alias("title"), redirect.alias("redirect"))).select("p_partkey", "title")


@query("namespaces", f"WITH t AS (SELECT p_partkey, {_TITLE} AS title FROM part) SELECT p_partkey, CASE WHEN p_partkey % 12 <= 9 THEN split_part(title, ':', 1) ELSE '' END AS namespace, false AS shortcut FROM t")
def namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").select("p_partkey", F.expr(_TITLE).alias("title"))
    return t.select("p_partkey", namespace(F.col("title")).alias("namespace"), is_shortcut(F.col("title")).alias("shortcut"))


@query("page_lookup", "SELECT c_custkey, c_name AS title FROM customer WHERE c_name = (SELECT max(c_name) FROM customer)")
def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page by its title."""
    pages = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("title"))
    return find_page(pages, pages.agg(F.max("title")).first()[0])


def ordered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page a customer, linking to a page for each order; some of them don't exist, and many are linked twice."""
    text = F.concat_ws(" ", F.array_sort(F.collect_list(F.concat(F.lit("[[Page "), F.expr(f"o_orderkey * 7 % {table(spark, sf_dir, 'customer').count() * 4 // 3}").cast("string"), F.lit("|order]]")))))
    linked = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(text.alias("text"))
    pages = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("idx"), F.concat(F.lit("Page "), F.col("c_custkey").cast("string")).alias("title"))
    return pages.join(linked, pages["idx"] == linked["o_custkey"], "left").select("idx", "title", "text")


def ordered_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = ordered_pages(spark, sf_dir)
    index = g.page_index(pages)
    return g.edges(pages.select("idx", extract_links(F.col("text")).alias("links")), index), index


_EDGES = "SELECT o_custkey AS src, c_custkey AS dst FROM (SELECT *, o_orderkey * 7 % (SELECT count(*) * 4 // 3 FROM customer) AS linked FROM orders) JOIN customer ON linked = c_custkey WHERE o_custkey IN (SELECT c_custkey FROM customer)"


@query("page_links", "SELECT 'Page ' || c.c_custkey AS title, CAST(count(o_orderkey) AS INTEGER) AS n FROM customer c LEFT JOIN orders ON o_custkey = c.c_custkey GROUP BY c.c_custkey")
def page_links_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(ordered_pages(spark, sf_dir)).select("title", F.size("links").alias("n"))


@query("graph_edges", _EDGES)
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links joined to the pages that they name; links to no page drop out, repeated ones stay."""
    return ordered_graph(spark, sf_dir)[0]


@query("out_degree", f"SELECT src, count(*) AS degree FROM ({_EDGES}) GROUP BY src")
def out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.out_degree(ordered_graph(spark, sf_dir)[0])


@query("title_index", "SELECT p_brand AS title, max(p_partkey) AS idx FROM part GROUP BY p_brand")
def title_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of pages of one title the last."""
    return g.page_index(table(spark, sf_dir, "part").select(F.col("p_brand").alias("title"), F.col("p_partkey").alias("idx")))


_ROOT = "(SELECT min(src) FROM e)"
_GRAPH = f"e AS ({_EDGES})"


def _neighbourhood(spark: SparkSession, sf_dir: str, depth: float, **how) -> DataFrame:
    graph, index = ordered_graph(spark, sf_dir)
    graph = g.written(graph, "graph")
    root = graph.agg(F.min("src")).first()[0]
    return g.subgraph(graph, index, f"Page {root}", depth, **how)


@query("subgraph_1hop", f"WITH {_GRAPH} SELECT DISTINCT 'Page ' || dst AS title FROM e WHERE src = {_ROOT}")
def subgraph_1hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbourhood(spark, sf_dir, 3.0, mode=g.AS_COMPUTED)


@query("subgraph_khop", f"WITH RECURSIVE {_GRAPH}, r(n, h) AS (SELECT {_ROOT}, 0 UNION SELECT dst, h + 1 FROM r JOIN e ON n = src WHERE h < 2) SELECT DISTINCT 'Page ' || n AS title FROM r WHERE h > 0")
def subgraph_khop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _neighbourhood(spark, sf_dir, 2.9)


#: A nation's page links to two or three others; the graph is small enough for SQL to list every way.
_NATIONS = "n AS (SELECT n_nationkey AS k FROM nation), e AS (SELECT k AS src, (k * 2 + 1) % 25 AS dst FROM n UNION ALL SELECT k, (k * 3 + 2) % 25 FROM n UNION ALL SELECT k, (k + 5) % 25 FROM n WHERE k % 2 = 0)"


def nation_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    text = "'[[Nation ' || ((n_nationkey * 2 + 1) % 25) || ']] and [[Nation ' || ((n_nationkey * 3 + 2) % 25) || '|that]]' || CASE WHEN n_nationkey % 2 = 0 THEN ' [[Nation ' || ((n_nationkey + 5) % 25) || ']]' ELSE '' END || ' [[Nowhere]]'"
    pages = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("idx"), F.expr("'Nation ' || n_nationkey").alias("title"), F.expr(text).alias("text"))
    index = g.page_index(pages)
    return g.edges(pages.select("idx", extract_links(F.col("text")).alias("links")), index), index


@query("subgraph_nation_khop", f"WITH RECURSIVE {_NATIONS}, r(n, h) AS (SELECT 0, 0 UNION SELECT dst, h + 1 FROM r JOIN e ON n = src WHERE h < 3) SELECT DISTINCT 'Nation ' || n AS title FROM r WHERE h > 0")
def subgraph_nation_khop(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph, index = nation_graph(spark, sf_dir)
    return g.subgraph(graph, index, "Nation 0", 3.0)


@query(
    "subgraph_budget",
    f"WITH RECURSIVE {_GRAPH}, d AS (SELECT src, count(*) AS n FROM e GROUP BY src), r(n, b) AS (SELECT {_ROOT}, 1.5::DOUBLE UNION SELECT e.dst, b - d.n / 16.0::DOUBLE FROM r JOIN e ON r.n = e.src JOIN d ON d.src = e.src WHERE b > 0) SELECT DISTINCT 'Page ' || n AS title FROM r WHERE b < 1.5",
)
def subgraph_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a budget of 1.5 reaches where each page's links cost a sixteenth of their number; sixteenths are exact in either engine."""
    return _neighbourhood(spark, sf_dir, 1.5, method="depth-limited-with-fan-out-factor", fanout=16.0)


@query("index_offsets", "SELECT doc_id, source, CAST(coalesce(sum(n) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_offset, CAST(sum(n) OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS end_offset FROM (SELECT doc_id, source, strlen(text) AS n FROM documents)")
def index_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte offsets of records in data files, one file a source."""
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", F.octet_length("text").alias("n"))
    return offsets(sized, F.col("n"), ["source"], ["doc_id"]).select("doc_id", "source", "start_offset", "end_offset")


_RECORD = "'{\"k\":' || c_custkey || ',\"name\":\"' || c_name || '\"}'"


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A record a customer, written with its index."""
    data, index = scratch(spark, "data"), scratch(spark, "index")
    write_indexed(table(spark, sf_dir, "customer").select(F.col("c_name").alias("title"), F.expr(_RECORD).alias("record")), data, index, files=3)
    return data, index


@query("index_round_trip", f"SELECT count(*) AS records, CAST(sum(strlen({_RECORD}) + 1) AS BIGINT) AS bytes FROM customer")
def index_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written with their index, and the index read back: as many entries, and the bytes of the data."""
    data, index = _indexed(spark, sf_dir)
    written = spark.read.text(data).agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    return read_index(spark, index).agg(F.count("*").alias("records")).crossJoin(written)


@query("slice_scan", f"SELECT c_name AS title, {_RECORD} AS record FROM customer")
def slice_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record by the offsets of its index."""
    return read_slices(spark, *_indexed(spark, sf_dir))


@query("page_by_offset", f"SELECT c_name AS title, {_RECORD} AS record FROM customer WHERE c_name = (SELECT max(c_name) FROM customer)")
def page_by_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record by a seek to its offset."""
    title = table(spark, sf_dir, "customer").agg(F.max("c_name")).first()[0]
    return spark.createDataFrame([(title, read_page(spark, *_indexed(spark, sf_dir), title))], "title string, record string")


@query("dump_scan", "SELECT c_name AS title, chr(10) || 'The customer ' || c_name || ' & <ref>' || c_custkey || '</ref>' AS text FROM customer WHERE c_custkey % 5 <> 0")
def dump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump written and scanned: of two revisions the last counts, redirects and meta pages drop out, a leading line feed stays."""
    path = scratch(spark, "dump")
    text = lambda t: F.struct(F.struct(F.expr(t).alias("_VALUE"), F.lit("7").alias("_bytes")).alias("text"))
    page = spread(spark, sf_dir, "customer").select(
        F.expr("CASE WHEN c_custkey % 10 = 5 THEN 'Help:' ELSE '' END || c_name").alias("title"),
        F.lit(0).alias("ns"),
        F.when(F.col("c_custkey") % 10 == 0, F.struct(F.lit("Elsewhere").alias("_title"))).alias("redirect"),
        F.array(text("'old'"), text("concat('\\n', 'The customer ', c_name, ' & <ref>', c_custkey, '</ref>')")).alias("revision"),
    )
    page.write.format("xml").options(rowTag="page", rootTag="mediawiki", declaration="").save(path)
    return read_dump(spark, path)

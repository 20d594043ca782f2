"""The link graph: edges, out-degrees and neighbourhoods of a root page."""

from __future__ import annotations

import math
import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindrift.session import checkpoints, scratch

DOCUMENTED, AS_COMPUTED = "documented", "as_computed"


def page_index(pages: DataFrame) -> DataFrame:
    """(title, idx): of pages of one title the last counts."""
    return pages.groupBy("title").agg(F.max("idx").alias("idx"))


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: what several actions read is made once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def heavy_targets(links: DataFrame, most: int = 1000, tracked: int = 20_000) -> list[str]:
    """At most so many targets, each of a ten-thousandth of all links or more by a frequent-items sketch: tasks sketch their own links, and sketches of bounded size are merged."""
    return _heavy(links.select(F.explode("links.target").alias("target")), most, tracked)


def _heavy(targets: DataFrame, most: int = 1000, tracked: int = 20_000) -> list[str]:
    found = targets.filter("target IS NOT NULL").agg(F.count("*").alias("n"), F.expr(f"approx_top_k(target, {most}, {tracked})").alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] * 10_000 >= found["n"] and t["count"] > 1]


def edges(links: DataFrame, index: DataFrame, heavy: list[str] | None = None) -> DataFrame:
    """links(idx, links) as (src, dst): a row a link whose target is a page, repeated links included.

    heavy: targets of very many links; none given: they are found as heavy_targets() does, for which the links are written
    to the shared folder, so that they are extracted once for all that reads them. Their pages, of which there are a bounded
    number, are broadcast, so a hub's links stay in the tasks that read them; the others are joined as the planner chooses.
    """
    titles = index.select(F.col("title").alias("target"), F.col("idx").alias("dst"))
    # explode_outer, as for explode the planner asks beforehand whether there are links, which extracts them once more.
    targets = links.select(F.col("idx").alias("src"), F.explode_outer("links.target").alias("target")).filter("target IS NOT NULL")
    if heavy is None:
        targets = written(targets, "links")
        heavy = _heavy(targets)
    if not heavy:
        return targets.join(titles, "target").select("src", "dst")
    known = F.broadcast(index.sparkSession.createDataFrame([(t,) for t in heavy], "target string"))
    hubs = F.broadcast(titles.join(known, "target"))
    return targets.join(hubs, "target").select("src", "dst").union(targets.join(known, "target", "left_anti").join(titles, "target").select("src", "dst"))


def out_degree(graph: DataFrame) -> DataFrame:
    """(src, degree), repeated links counted; counted in each task before the shuffle."""
    return graph.groupBy("src").agg(F.count("*").alias("degree"))


def root_of(index: DataFrame, title: str) -> int:
    """The root's idx; ValueError if there is no such page."""
    found = index.filter(F.col("title") == title).agg(F.max("idx")).first()[0]
    if found is None:
        raise ValueError(f"no page is titled {title!r}")
    return found


def _direct(graph: DataFrame, root: int) -> DataFrame:
    return graph.filter(F.col("src") == root).select(F.col("dst").alias("node")).distinct()


def _hops(depth: float) -> int:
    return 0 if math.isnan(depth) or depth <= 0 else int(min(depth, 1 << 31))


class Bucketed:
    """A table in the shared folder whose rows are dealt by a column to so many buckets, each written and read by one task:
    joins and aggregates by that column, among tables of as many buckets, need no shuffle. round: a column of partitions."""

    def __init__(self, spark: SparkSession, name: str, by: str, buckets: int):
        checkpoints(spark)
        self.spark, self.by, self.buckets, self.path = spark, by, buckets, scratch(spark, name)
        self.name = f"spindrift_{name}_{uuid.uuid4().hex}"

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, self.by)

    def add(self, rows: DataFrame) -> None:
        """Appends rows, which are dealt already."""
        writer = rows.write.bucketBy(self.buckets, self.by).mode("append").option("path", self.path)
        (writer.partitionBy("round") if "round" in rows.columns else writer).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def leave(self) -> DataFrame:
        """The rows as files: the table's entry in the catalog goes."""
        schema = self.read().schema
        self.spark.sql(f"DROP TABLE {self.name}")
        return self.spark.read.schema(schema).parquet(self.path)


def _buckets(graph: DataFrame) -> int:
    return int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hop(pairs: Bucketed, visited: Bucketed, last: int) -> DataFrame:
    """(node): what links from the nodes of round last lead to, less what was visited. Frontier, edges and visited nodes lie
    in the same buckets, so only the nodes that are found are shuffled, once a task."""
    frontier = visited.read().filter(F.col("round") == last).select(F.col("node").alias("src"))
    found = frontier.join(pairs.read(), "src").select(F.col("dst").alias("node")).distinct()
    return found.join(visited.read().select("node"), "node", "left_anti")


def within_depth(graph: DataFrame, root: int, depth: float, mode: str = DOCUMENTED, buckets: int | None = None) -> DataFrame:
    """(node): what at most depth links lead to from root. as_computed gives the direct links for any depth of 1 or more.

    One round a hop. Edges are dealt to buckets by their source once, visited nodes lie in as many; buckets: how many, by
    default as many as a shuffle has partitions. The root is in the result only if a link leads to it.
    """
    hops = _hops(depth)
    if not hops:
        return graph.select(F.col("dst").alias("node")).limit(0)
    if mode == AS_COMPUTED or hops == 1:
        return _direct(graph, root)
    spark, n = graph.sparkSession, buckets or _buckets(graph)
    pairs, visited = Bucketed(spark, "pairs", "src", n), Bucketed(spark, "visited", "node", n)
    pairs.add(pairs.dealt(graph.select("src", "dst")).distinct())
    first = pairs.read().filter(F.col("src") == root).select(F.col("dst").alias("node"))
    visited.add(visited.dealt(first).distinct().withColumn("round", F.lit(0)))
    for last in range(hops - 1):
        if not visited.read().filter(F.col("round") == last).head(1):
            break
        visited.add(hop(pairs, visited, last).withColumn("round", F.lit(last + 1)))
    pairs.leave()
    return visited.leave().select("node")


class BudgetWalk:
    """Largest budgets from a root, settled in bands: a round expands each open page whose budget no other can still raise.

    An open page leaves its links what it has less its own cost. The largest of these is where a round's band ends: what
    has as much or more is settled, however many links led to it. So bands are as wide as the costs at hand allow, and a
    page is expanded once. What is found is appended to a log in buckets by node, whose state is an aggregate without a shuffle.
    """

    def __init__(self, graph: DataFrame, root: int, depth: float, fanout: float, buckets: int | None = None):
        self.spark, n = graph.sparkSession, buckets or _buckets(graph)
        self.links, self.costs, self.log = Bucketed(self.spark, "links", "src", n), Bucketed(self.spark, "costs", "src", n), Bucketed(self.spark, "budgets", "node", n)
        self.links.add(self.links.dealt(graph.select("src", "dst")).groupBy("src", "dst").agg(F.count("*").alias("times")))
        self.costs.add(self.links.read().groupBy("src").agg((F.sum("times") / F.lit(float(fanout))).alias("cost")))
        start = self.spark.createDataFrame([(root, float(depth), None, False)], "node long, budget double, expanded double, reached boolean")
        self.log.add(self.log.dealt(start))

    def state(self) -> DataFrame:
        """(node, budget, expanded, reached): a node's largest budget, the largest it was expanded with, and whether a link leads to it."""
        return self.log.read().groupBy("node").agg(F.max("budget").alias("budget"), F.max("expanded").alias("expanded"), F.max("reached").alias("reached"))

    def open(self) -> DataFrame:
        """state() of the nodes that are still to expand, with their cost."""
        state = self.state().filter((F.col("budget") > 0) & (F.col("expanded").isNull() | (F.col("budget") > F.col("expanded"))))
        return state.join(self.costs.read().withColumnRenamed("src", "node"), "node")

    def step(self, floor: float) -> DataFrame:
        """What the open nodes from floor on lead to, the best for each node, and these nodes as expanded."""
        now = self.open().filter(F.col("budget") >= floor)
        found = now.select(F.col("node").alias("src"), (F.col("budget") - F.col("cost")).alias("budget")).join(self.links.read(), "src")
        found = found.groupBy(F.col("dst").alias("node")).agg(F.max("budget").alias("budget"))
        expanded = now.select("node", "budget", F.col("budget").alias("expanded"), "reached")
        return found.select("node", "budget", F.lit(None).cast("double").alias("expanded"), F.lit(True).alias("reached")).union(expanded)

    def run(self) -> BudgetWalk:
        while (floor := self.open().agg(F.max(F.col("budget") - F.col("cost"))).first()[0]) is not None:
            self.log.add(self.step(floor))
        return self

    def nodes(self) -> DataFrame:
        """(node) that links lead to; the walk is over then."""
        self.links.leave()
        self.costs.leave()
        return self.log.leave().filter("reached").select("node").distinct()


def within_budget(graph: DataFrame, root: int, depth: float, fanout: float, mode: str = DOCUMENTED, buckets: int | None = None) -> DataFrame:
    """(node): what is reached from root with a budget of depth, of which a page's links each leave budget - links / fanout.

    A page is expanded while its budget is above 0, and of several ways to it the one with the largest budget counts, band
    by band of budgets (see BudgetWalk). as_computed gives the direct links for any depth above 0.
    """
    if not fanout > 0:
        raise ValueError("fanout must be above 0")
    if not depth > 0:
        return graph.select(F.col("dst").alias("node")).limit(0)
    if mode == AS_COMPUTED:
        return _direct(graph, root)
    return BudgetWalk(graph, root, depth, fanout, buckets).run().nodes()


METHODS = {"depth-limited": within_depth, "depth-limited-with-fan-out-factor": within_budget}


def subgraph(graph: DataFrame, index: DataFrame, root: str, depth: float, method: str = "depth-limited", fanout: float | None = None, mode: str = DOCUMENTED) -> DataFrame:
    """(title): the titles of a neighbourhood of the page titled root."""
    at = root_of(index, root)
    if method == "depth-limited":
        if fanout is not None:
            warnings.warn("fanout is ignored by depth-limited", stacklevel=2)
        found = within_depth(graph, at, depth, mode)
    elif method in METHODS:
        if fanout is None:
            raise ValueError(f"{method} needs a fanout")
        found = within_budget(graph, at, depth, fanout, mode)
    else:
        raise ValueError(f"method is one of {', '.join(METHODS)}")
    return found.join(index.select(F.col("idx").alias("node"), "title"), "node").select("title").distinct()

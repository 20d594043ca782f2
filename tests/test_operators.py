import bz2
import gzip
import heapq
import json
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from spindrift.functions.namespaces import is_shortcut, namespace
from spindrift.functions.progress import Progress, progress_line
from spindrift.operators import graph as g
from spindrift.operators.extract import extract
from spindrift.operators.links import extract_links
from spindrift.operators.ordered import running_sum
from spindrift.operators.sections import as_variant, section_tree, sections, tree, tree_json
from spindrift.plans import engine
from spindrift.sources.dump import DumpError, broken_pages, located, read_dump, read_index, read_page, read_page_links, read_pages, read_slices
from spindrift.sources.sinks import write_indexed, write_json_lines, write_titles
from spindrift.streaming.extract import run_extraction

LINKS = {
    "[[A]]": [("A", "A")],
    "[[A|b|c]]": [("A", "b|c")],
    "[[A|]]": [("A", "")],
    "[[]]": [("", "")],
    "[[A": [],
    "[[[x]]]": [("[x", "[x")],
    "[[F{{a|b}}|z]]": [("F{{a|b}}", "z")],
    "[[A}|b]]": [("A}|b", "A}|b")],
    "[[File:a|thumb|see [[B]] x]]": [("File:a", "thumb|see [[B")],
    "é[[中\n文|x]] [[b]] [[c": [("中\n文", "x"), ("b", "b")],
    "": [],
    None: [],
}


def test_links(spark):
    rows = spark.createDataFrame(list(enumerate(LINKS)), "i int, t string").select("i", extract_links(F.col("t")).alias("l")).orderBy("i").collect()
    assert [[tuple(x) for x in r["l"]] for r in rows] == list(LINKS.values())


DUMP = """<mediawiki xml:lang="en"><siteinfo><sitename>x</sitename></siteinfo>
<page><title>Plain</title><ns>0</ns><id>1</id><revision><id>3</id><timestamp>t</timestamp><text bytes="9">
lead [[Two]]</text></revision></page>
<page><title>Gone</title><redirect title="Plain" /><revision><text>r</text></revision></page>
<page><title>Two</title><revision><text>one</text></revision><revision><text>two [[Plain|p]] [[Nope]]</text></revision></page>
<page><title>Empty</title><revision><text bytes="0" /></revision><odd>1</odd></page>
<page><title>AT&amp;T</title><revision><text>&amp;nbsp; &lt;ref&gt;x&lt;/ref&gt; &amp;mdash;</text></revision></page>
<page><title>Talk:X</title><revision><text>t</text></revision></page>
<page><title>wikipedia:x</title><revision><text>t</text></revision></page>
<page><title>Foo (Disambiguation)</title><revision><text>t</text></revision></page>
META</mediawiki>"""
META = "".join(f"<page><title>{p}:x</title><revision><text>t</text></revision></page>\n" for p in ["Wikipedia", "Portal", "File", "Template", "Category", "Draft", "Module", "MediaWiki", "Help"])


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "dump.xml"
    path.write_text(DUMP.replace("META", META))
    return path


def test_dump_scan(spark, dump):
    kept = {r["title"]: r["text"] for r in read_dump(spark, str(dump)).collect()}
    assert kept == {"Plain": "\nlead [[Two]]", "Two": "two [[Plain|p]] [[Nope]]", "Empty": "", "AT&T": "&nbsp; <ref>x</ref> &mdash;", "Talk:X": "t", "wikipedia:x": "t"}
    assert read_pages(spark, str(dump)).count() == 17


def test_compressed_dump(spark, dump, tmp_path):
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(dump.read_bytes()))
    assert read_dump(spark, str(tmp_path / "d.xml.bz2")).count() == 6


def test_contents_of_a_dump(spark, dump):
    found = {r["title"]: json.loads(r["record"]) for r in extract(read_dump(spark, str(dump)), "contents").collect()}
    assert found["AT&T"] == {"section_name": "AT&T", "text": "&mdash;\n", "children": []}
    assert found["Empty"]["text"] == ""


def test_a_function_may_extract(spark, dump):
    assert extract(read_dump(spark, str(dump)), lambda d: d.select(F.length("title").alias("n"))).count() == 6


def test_stream_gives_the_same_records(spark, dump, tmp_path):
    run_extraction(spark, str(dump.parent), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    batch = {tuple(r) for r in extract(read_dump(spark, str(dump)), "links").collect()}
    assert {(r["title"], r["record"]) for r in spark.read.json(str(tmp_path / "out")).collect()} == batch


def test_command_line(spark, dump, tmp_path, capsys):
    data, index, out = (str(tmp_path / x) for x in ("data", "index", "titles"))
    assert engine.main(["parse", "-i", str(dump), "--output-data", data, "--output-index", index, "-e", "links", "--files", "2"]) == 0
    assert read_page_links(spark, data).count() == 6
    assert engine.main(["subgraph", "--input-data", data, "-r", "Plain", "-d", "2", "-o", out]) == 0
    assert {r[0] for r in spark.read.text(out).collect()} == {"Two", "Plain"}
    assert engine.main(["page", "--input-data", data, "--input-index", index, "-t", "Two"]) == 0
    assert json.loads(capsys.readouterr().out)["links"][0] == {"target": "Plain", "label": "p"}
    assert engine.main(["subgraph", "--input-data", data, "-r", "None such", "-d", "2", "-o", str(tmp_path / "none")]) == 0
    assert "None such" in capsys.readouterr().err
    assert engine.main(["subgraph", "--input-data", data, "-r", "Plain", "-d", "2", "-m", "depth-limited-with-fan-out-factor", "-o", str(tmp_path / "none")]) == 2


def test_index_leads_to_its_records(spark, tmp_path):
    rows = [(f"T{i}: é", json.dumps({"i": i}) * (i % 5 + 1)) for i in range(40)] + [("T1: é", "again"), ("empty", "")]
    data, index = str(tmp_path / "data"), str(tmp_path / "index")
    for k, files in enumerate((3, None)):
        write_indexed(spark.createDataFrame(rows, "title string, record string").repartition(2), f"{data}{k}", f"{index}{k}", files=files)
        assert len(list((tmp_path / f"data{k}").glob("part-*"))) == (files or 2)
        assert sorted(f.name for f in (tmp_path / f"data{k}").iterdir()) == sorted(f.name for f in (tmp_path / f"index{k}").glob("part-*"))
        assert sorted(map(tuple, read_slices(spark, f"{data}{k}", f"{index}{k}").collect())) == sorted(rows)
        numbered = read_index(spark, f"{index}{k}").collect()
        for file in {r["file"] for r in numbered}:
            own = sorted((r for r in numbered if r["file"] == file), key=lambda r: r["idx"])
            assert [r["idx"] for r in own] == list(range(len(own)))
            assert [r["end_offset"] for r in own] == [r["start_offset"] for r in own[1:]] + [None]
        assert read_page(spark, f"{data}{k}", f"{index}{k}", "T7: é") == dict(rows)["T7: é"]
        assert read_page(spark, f"{data}{k}", f"{index}{k}", "empty") == ""
        assert read_page(spark, f"{data}{k}", f"{index}{k}", "none") is None


def test_an_index_of_several_splits(spark, tmp_path):
    """Ends and numbers go over from split to split of one index file."""
    (tmp_path / "index").write_text("".join(f"{10 * i}: title {i}\n" for i in range(500)))
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    try:
        found = sorted(map(tuple, read_index(spark, str(tmp_path / "index")).select("idx", "title", "start_offset", "end_offset").collect()))
    finally:
        spark.conf.set(name, before)
    assert found == [(i, f"title {i}", 10 * i, 10 * i + 10 if i < 499 else None) for i in range(500)]


def test_running_sums_of_a_hot_part(spark):
    rows = [("hot" if i % 5 else None, i, i % 9) for i in range(2000)]
    df = spark.createDataFrame(rows, "p string, i int, n long").repartition(6)
    found = {r["i"]: r["s"] for r in running_sum(df, F.col("n"), ["p"], ["i"], "s").collect()}
    sums = {}
    for p, i, n in rows:
        assert found[i] == sums.get(p, 0)
        sums[p] = sums.get(p, 0) + n


def test_download(spark, dump, tmp_path):
    packed = tmp_path / "packed.xml.bz2"
    packed.write_bytes(bz2.compress(dump.read_bytes()))
    assert engine.main(["fetch", "-u", packed.as_uri(), "-o", str(tmp_path / "got.xml.bz2")]) == 0
    assert read_dump(spark, str(tmp_path / "got.xml.bz2")).count() == 6


@pytest.mark.parametrize("split", ["100", "1000", "128m"])
@pytest.mark.parametrize("packed", [False, True])
def test_a_broken_page_is_told_with_its_position(spark, tmp_path, split, packed):
    """Positions count bytes from the file's start, whatever its splits, and of packed files the bytes unpacked."""
    raw = DUMP.replace("META", "<page><title>é x</title></page>" * 30 + "<page><title>x</revision></page>\n<page id='2'><title>y</title></page>" + "<page ><title>z</text></page>").encode()
    path = tmp_path / ("d.xml.gz" if packed else "d.xml")
    path.write_bytes(gzip.compress(raw) if packed else raw)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, split)
    try:
        with pytest.raises(DumpError, match=f"error at position {raw.index(b'<page><title>x</rev')} of file:.*d.xml"), located(spark, str(path)):
            read_dump(spark, str(path)).collect()
        found = sorted(r["position"] for r in broken_pages(spark, str(path)).collect())
    finally:
        spark.conf.set(name, before)
    assert found == [raw.index(b"<page><title>x</rev"), raw.index(b"<page ><title>z")]


@pytest.mark.parametrize("packed", [False, True])
def test_a_dump_of_one_file_is_read_in_splits(spark, tmp_path, packed):
    rng = random.Random(2)
    titles = [f"é {i} {rng.getrandbits(256):x}" for i in range(8000)]
    raw = DUMP.replace("META", "".join(f"<page id='1'><title>{t}</title><revision><text>\n a &lt;b&gt; {t}{rng.getrandbits(1200):x}</text></revision></page>\n" for t in titles)).encode()
    path = tmp_path / ("d.xml.bz2" if packed else "d.xml")
    path.write_bytes(bz2.compress(raw, 1) if packed else raw)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "300000")
    try:
        found = read_dump(spark, str(path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(r["title"] for r in found if r["title"].startswith("é")) == sorted(titles)
    assert len(found) == len(titles) + 6
    assert all(r["text"].startswith(f"\n a <b> {r['title']}") for r in found if r["title"].startswith("é"))
    assert len({r["task"] for r in found}) > 4


@pytest.mark.parametrize("meta, message", [("<page/>", "no title"), ("<!-- <page><title>x</title></page> -->", "comment"), ("<page><title>x</title><revision><text><![CDATA[</page>]]></text></revision></page>", "MALFORMED")])
def test_odd_places_of_a_pages_tags_are_errors(spark, tmp_path, meta, message):
    path = tmp_path / "d.xml"
    path.write_text(DUMP.replace("META", meta))
    with pytest.raises(Exception, match=message):
        read_dump(spark, str(path)).collect()


def test_other_errors_are_left_alone(spark, dump):
    with pytest.raises(Exception, match="own error"), located(spark, str(dump)):
        read_dump(spark, str(dump)).select(F.raise_error(F.lit("own error"))).collect()


@pytest.mark.parametrize("title", ["<title></title>", "<title />", ""])
def test_a_page_without_a_title_is_an_error(spark, tmp_path, title):
    path = tmp_path / "d.xml"
    path.write_text(DUMP.replace("META", f"<page>{title}<revision><text>x</text></revision></page>"))
    with pytest.raises(DumpError, match="no title"), located(spark, str(path)):
        read_dump(spark, str(path)).collect()
    path.write_text(DUMP.replace("META", f"<page>{title}<redirect title='Plain' /><revision><text>x</text></revision></page>"))
    assert read_dump(spark, str(path)).count() == 6


def test_another_root_is_refused(spark, tmp_path):
    path = tmp_path / "d.xml"
    for raw in (DUMP.replace("mediawiki", "wiki"), "", "<page><title>x</title></page>"):
        path.write_text("<?xml version='1.0'?>\n<!-- <mediawiki> -->\n" + raw.replace("META", ""))
        with pytest.raises(DumpError, match="root is"):
            read_dump(spark, str(path))
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(b"\xef\xbb\xbf<?xml version='1.0'?><!DOCTYPE x>" + DUMP.replace("META", "").encode()))
    assert read_dump(spark, str(tmp_path / "d.xml.bz2")).count() == 6


def test_links_of_texts_that_never_close(spark):
    """A megabyte of openings, and a link of half a megabyte with braces."""
    texts = ["[[" * 500_000, "[[a]]" + "[[" * 400_000, "[[" + "{a|}" * 100_000 + "|b]]"]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(1)
    began = time.perf_counter()
    found = {r["i"]: r["l"] for r in d.select("i", extract_links(F.col("t")).alias("l")).collect()}
    assert [len(found[i]) for i in range(3)] == [0, 1, 1]
    assert tuple(found[2][0]) == ("{a|}" * 100_000, "b")
    assert time.perf_counter() - began < 60


def test_sections_of_any_number_and_depth(spark):
    flat = "".join(f"== h{i} ==\nt{i}\n" for i in range(20_000))
    deep = "".join(f"{'=' * i} h{i} {'=' * i}\n" for i in range(2, 3000)) + "end"
    d = spark.createDataFrame([(0, "T", flat), (1, "T", deep)], "i int, t string, x string")
    began = time.perf_counter()
    assert {r["i"]: r["count"] for r in sections(d, "i", "t", "x").groupBy("i").count().collect()} == {0: 20_001, 1: 2999}
    assert time.perf_counter() - began < 60
    assert len(tree_json("T", deep)) > 3000 * 3000
    for article in ARTICLES:
        assert tree_json("T é", article) == json.dumps(tree("T é", article), indent=2, ensure_ascii=False)


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([("a",), ("é",)], "title string")
    write_titles(d, str(tmp_path / "t"))
    write_json_lines(d, str(tmp_path / "j"))
    assert {r[0] for r in spark.read.text(str(tmp_path / "t")).collect()} == {r["title"] for r in spark.read.json(str(tmp_path / "j")).collect()} == {"a", "é"}


@pytest.fixture(scope="module")
def small_graph(spark):
    pages = spark.createDataFrame([(0, "A", ["B", "B", "C", "Z"]), (1, "B", ["A", "D"]), (2, "C", ["C"]), (3, "D", ["E"]), (4, "E", []), (5, "B", ["E"])], "idx long, title string, t array<string>")
    pages = pages.filter("idx < 5")
    links = pages.select("idx", "title", F.transform("t", lambda x: F.struct(x.alias("target"), x.alias("label"))).alias("links"))
    index = g.page_index(pages)
    return g.edges(links, index), index


def test_edges_and_degrees(small_graph):
    graph, _ = small_graph
    assert sorted(map(tuple, graph.collect())) == [(0, 1), (0, 1), (0, 2), (1, 0), (1, 3), (2, 2), (3, 4)]
    assert sorted(map(tuple, g.out_degree(graph).collect())) == [(0, 3), (1, 2), (2, 1), (3, 1)]


@pytest.mark.parametrize(
    ("root", "depth", "how", "computed", "documented"),
    [
        ("A", 0, {}, "", ""),
        ("A", -1, {}, "", ""),
        ("A", float("nan"), {}, "", ""),
        ("A", 1, {}, "BC", "BC"),
        ("A", 1.9, {}, "BC", "BC"),
        ("A", 2, {}, "BC", "ABCD"),
        ("A", 3, {}, "BC", "ABCDE"),
        ("A", 90, {}, "BC", "ABCDE"),
        ("A", 2, {"method": "depth-limited-with-fan-out-factor", "fanout": 2}, "BC", "ABCD"),
        ("A", 0, {"method": "depth-limited-with-fan-out-factor", "fanout": 2}, "", ""),
        ("C", 1, {}, "C", "C"),
        ("E", 3, {}, "", ""),
    ],
)
def test_subgraphs(small_graph, root, depth, how, computed, documented):
    for mode, titles in ((g.AS_COMPUTED, computed), (g.DOCUMENTED, documented)):
        assert {r[0] for r in g.subgraph(*small_graph, root, depth, mode=mode, **how).collect()} == set(titles)


def exchanges(df):
    """The shuffles of a plan with what is below each, down to the scans, by indentation."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def random_graph(spark, n=300, links=1500, seed=3):
    rng = random.Random(seed)
    rows = [(rng.randrange(n), min(rng.randrange(n), rng.randrange(n))) for _ in range(links)]
    return rows, spark.createDataFrame(rows, "src long, dst long")


def test_a_hop_shuffles_what_it_finds_only(spark):
    """Neither edges nor visited nodes are below an exchange, but for the join of the frontier, whose result is shuffled."""
    _, graph = random_graph(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs, visited = g.Bucketed(spark, "pairs", "src", n), g.Bucketed(spark, "visited", "node", n)
    pairs.add(pairs.dealt(graph).distinct())
    visited.add(visited.dealt(spark.range(5).withColumnRenamed("id", "node")).withColumn("round", F.lit(0)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        count, plan = exchanges(g.hop(pairs, visited, 0))
        assert count == 1 and plan.count("Bucketed: true") == 3
        joins = [i for i, line in enumerate(plan.splitlines()) if "SortMergeJoin" in line]
        shuffle = next(i for i, line in enumerate(plan.splitlines()) if "Exchange" in line)
        assert joins[0] < shuffle < joins[1]  # below the outer join, above the one with the edges
        walk = g.BudgetWalk(graph, 0, 3.0, 8.0)
        assert exchanges(walk.step(0.0))[0] == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("buckets", [None, 3])
@pytest.mark.parametrize("depth", [2, 3, 50])
def test_nodes_within_a_depth_are_those_of_a_walk(spark, depth, buckets):
    rows, graph = random_graph(spark)
    frontier, reached = {7}, set()
    for _ in range(depth):
        frontier = {d for s, d in rows if s in frontier} - reached
        reached |= frontier
    assert {r["node"] for r in g.within_depth(graph, 7, depth, buckets=buckets).collect()} == reached


@pytest.mark.parametrize("depth,fanout", [(4.0, 8.0), (2.5, 16.0), (1.0, 3.0)])
def test_nodes_within_a_budget_are_those_of_a_walk_and_expanded_once(spark, depth, fanout):
    rows, graph = random_graph(spark)
    out = {s: [d for x, d in rows if x == s] for s, _ in rows}
    best, queue, reached = {7: depth}, [(-depth, 7)], set()
    while queue:
        b, node = heapq.heappop(queue)
        if -b < best[node] or b >= 0:
            continue
        for d in out.get(node, []):
            left = -b - len(out[node]) / fanout
            reached.add(d)
            if left > best.get(d, -math.inf):
                best[d] = left
                heapq.heappush(queue, (-left, d))
    walk = g.BudgetWalk(graph, 7, depth, fanout).run()
    log = walk.log.read().filter("expanded IS NOT NULL").groupBy("node").count().collect()
    assert {r["node"] for r in walk.state().filter("reached").collect()} == reached == {r["node"] for r in walk.nodes().collect()}
    assert {r["node"]: r["count"] for r in log} == {n: 1 for n, b in best.items() if b > 0 and n in out}


def test_a_hub_of_half_of_all_links_stays_where_they_are_read(spark):
    n = 40_000
    target = F.when(F.col("id") % 2 == 0, F.lit("Hub")).otherwise(F.concat(F.lit("P"), (F.col("id") * 7 % 5003).cast("string")))
    links = spark.range(n, numPartitions=4).select(F.col("id").alias("idx"), F.array(F.struct(target.alias("target"), F.lit("x").alias("label"))).alias("links"))
    index = spark.range(5003).select(F.concat(F.lit("P"), "id").alias("title"), "id").union(spark.createDataFrame([("Hub", 9999)], "t string, i long")).toDF("title", "idx")
    assert g.heavy_targets(links)[0] == "Hub" and len(g.heavy_targets(links)) <= 1000
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("-1", "false"), strict=True):
        spark.conf.set(name, value)
    try:
        found = g.edges(links, index, ["Hub"])
        tasks = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
        assert sum(tasks) == n and tasks[-1] <= 2 * tasks[len(tasks) // 2 - 1] <= 12_000
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert found.filter("dst = 9999").count() == n // 2
    key = lambda df: sorted(map(tuple, df.groupBy("src", "dst").count().collect()))
    assert key(found) == key(g.edges(links, index, [])) == key(g.edges(links, index))


def test_subgraph_refuses(small_graph):
    with pytest.raises(ValueError, match="no page"):
        g.subgraph(*small_graph, "Q", 1)
    with pytest.raises(ValueError, match="fanout"):
        g.subgraph(*small_graph, "A", 1, method="depth-limited-with-fan-out-factor")
    with pytest.raises(ValueError, match="above 0"):
        g.subgraph(*small_graph, "A", 1, method="depth-limited-with-fan-out-factor", fanout=0)
    with pytest.raises(ValueError, match="method"):
        g.subgraph(*small_graph, "A", 1, method="x")
    with pytest.warns(UserWarning, match="ignored"):
        g.subgraph(*small_graph, "A", 1, fanout=2)


ARTICLES = ["a\n== B ==\nb\n=== C ===\nc\n== D ==\n", "== First ==\nx", "", "x\n===\n== Foo\ny\n  == In ==  \n z \n==== Deep ====\n=== Up ===\nq\r\nr", "== A ==\n=== B ===\n==== C ====\nz"]


def test_tree():
    assert tree("T", ARTICLES[0]) == {"section_name": "T", "text": "a\n", "children": [{"section_name": "B", "text": "b\n", "children": [{"section_name": "C", "text": "c\n", "children": []}]}]}


def test_flat_sections_agree_with_the_tree(spark):
    d = spark.createDataFrame(list(enumerate(ARTICLES)), "i int, t string").withColumn("title", F.lit("T"))
    rows = sections(d, "i", "title", "t").collect()
    for i, article in enumerate(ARTICLES):
        def flat(node, parent, out):
            out.append((node["section_name"], node["text"], parent))
            for c in node["children"]:
                flat(c, node["section_name"], out)
            return out

        own = {r["idx"]: r for r in rows if r["i"] == i}
        named = [(r["section_name"], r["text"], own[r["parent_idx"]]["section_name"] if r["parent_idx"] is not None else None) for _, r in sorted(own.items())]
        assert named == flat(tree("T", article), None, [])


def test_tree_as_variant(spark):
    d = spark.createDataFrame([("T", ARTICLES[0]), (None, "x")], "title string, text string").select(section_tree("title", "text").alias("j"))
    assert d.filter("j IS NOT NULL").select(F.variant_get(as_variant(F.col("j")), "$.children[0].section_name", "string")).first()[0] == "B"
    assert d.first()["j"].startswith('{\n  "section_name": "T",\n  "text": "a\\n",\n  "children": [')


def test_namespaces(spark):
    rows = spark.createDataFrame([("WP:X",), ("User talk:a",), ("Plain",), ("H:x",), ("Odd: x",)], "t string").select(namespace(F.col("t")), is_shortcut(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("Wikipedia", False), ("User talk", False), ("", False), ("", True), ("", False)]


def test_progress():
    assert progress_line(50, 200, 10, unit="pages") == "25.00% 50/200 | 5.0 pages/s (5.0 pages/s) | 00:30 (00:40)"
    p = Progress(200, window=5)
    p.line(0, 0.0)
    assert "| 10.0 rows/s (10.0 rows/s)" in p.line(60, 6.0)
    assert "| 20.0 rows/s (" in p.line(80, 7.0)
    assert progress_line(0, 0, 0).startswith("0.00%")


def test_links_are_extracted_once_for_all_that_reads_edges(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<struct<target:string,label:string>>")
    def extracted(i):
        calls.add(1)
        return [(f"P{i % 7}", ""), (f"P{i % 3}", "")]

    links = spark.range(40).select(F.col("id").alias("idx"), extracted("id").alias("links"))
    graph = g.edges(links, spark.range(9).select(F.concat(F.lit("P"), "id").alias("title"), F.col("id").alias("idx")))
    assert graph.count() == 80 and graph.filter("src = 8 AND dst = 1").count() == 1
    assert calls.value == 40

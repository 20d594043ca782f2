"""WARC, nearest neighbours, vector duplicates, URL filters, the pipeline."""

import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from spindrift.llm import ann, langid, pqdedup, quality, urlfilter, warc
from spindrift.llm import queries as q

# -- WARC

PAGES = "page_id long, url string, html string"


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def record(body, n=1):
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-record:{n}>\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n"


ODD = [
    None,
    "",
    "plain",
    "plain",
    record("forged"),
    "before " + record("forged", 77) + record("again", 78) + " after",
    "WARC/1.1\r\n" * 50,
    "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99999\r\n\r\nshort",
    "\r\n\r\nWARC/1.0\r\n\r\n",
    "é中\r\n" * 9000 + record("deep é", 9) * 3 + "x" * 70_000,
    record(record(record("nested"))),
    "WARC/1." * 20,
    "ends with WARC/1.",
]


@pytest.mark.parametrize("split", ["64k", "700b", "97b", "100m"])
def test_archives_are_a_round_trip(spark, tmp_path, split):
    rows = [(i, f"http://a.b/{i}?WARC/1.1 x\n", h) for i, h in enumerate(ODD)]
    pages = spark.createDataFrame(rows, PAGES).repartition(2)
    path = str(tmp_path / "a")
    warc.write(pages, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = {r["record_id"]: r for r in warc.read(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(found) == {f"<urn:x-record:{i}>" for i in range(len(ODD))}
    for i, h in enumerate(ODD):
        body, r = (h or "").encode(), found[f"<urn:x-record:{i}>"]
        last = max(j for j, other in enumerate(ODD) if (other or "") == (h or ""))
        assert (r["stated_digest"], int(r["stated_bytes"])) == (digest(body), len(body))
        if i == last:
            assert (r["type"], r["payload_bytes"], r["payload_digest"]) == ("response", len(body), digest(body))
        else:
            assert (r["type"], r["refers_to"], r["payload_bytes"]) == ("revisit", f"<urn:x-record:{last}>", 0)
        assert "WARC/" not in r["target_uri"]


def test_archives_hold_bytes(spark, tmp_path):
    raw = bytes(range(256)) * 3
    warc.write(spark.createDataFrame([(1, "u", bytearray(raw))], "page_id long, url string, html binary"), str(tmp_path / "a"))
    r = warc.read(spark, str(tmp_path / "a")).first()
    assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), digest(raw))


def test_other_archives_are_read(spark, tmp_path):
    (tmp_path / "a").mkdir()
    text = record("one") + record("two" + record("inner"), 2)
    (tmp_path / "a" / "x.warc").write_bytes(text.encode())
    (tmp_path / "a" / "y.warc").write_bytes(record("three", 3).encode())
    rows = warc.read(spark, str(tmp_path / "a")).orderBy("record_id").collect()
    assert [(r["offset"], r["payload_digest"]) for r in rows] == [(0, digest(b"one")), (len(record("one")), digest(("two" + record("inner")).encode())), (0, digest(b"three"))]
    (tmp_path / "a" / "z.warc").write_bytes(record("cut off").encode()[:-9])
    with pytest.raises(ValueError, match="ends at"):
        warc.read(spark, str(tmp_path / "a")).collect()


def test_packed_archives_are_read(spark, tmp_path):
    """A gzip member a record, as public archives have, and one of all; the same records as unpacked, and a torn one is an error."""
    records = [record("one"), record("two" + record("inner"), 2), record("é" * 9000, 3)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc.gz").write_bytes(b"".join(gzip.compress(r.encode()) for r in records))
    (tmp_path / "a" / "y.warc.gz").write_bytes(gzip.compress("".join(records).encode()))
    rows = warc.read(spark, str(tmp_path / "a")).orderBy("file", "offset").collect()
    starts = [sum(len(r.encode()) for r in records[:i]) for i in range(3)]
    assert [(r["offset"], r["payload_digest"]) for r in rows] == [*zip(starts, [digest(b"one"), digest(("two" + record("inner")).encode()), digest(("é" * 9000).encode())], strict=True)] * 2
    (tmp_path / "a" / "z.warc.gz").write_bytes(gzip.compress(records[0].encode()[:-9]))
    with pytest.raises(ValueError, match="ends at"):
        warc.read(spark, str(tmp_path / "a")).collect()


def test_archives_of_no_pages_and_of_repeated_ones(spark, tmp_path):
    warc.write(spark.createDataFrame([], PAGES), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
    warc.write(spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (None, None, "x"), (None, "u", "y")], PAGES), str(tmp_path / "more"))
    assert sorted((r["type"], r["record_id"]) for r in warc.read(spark, str(tmp_path / "more")).collect()) == [("response", "<urn:x-record:1>"), ("response", "<urn:x-record:1>"), ("response", "<urn:x-record:>"), ("revisit", "<urn:x-record:>")]


# -- nearest neighbours

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, a in good:
        if i % 20 == 0:
            score = sorted((-float(sum(x * y for x, y in zip(a, b, strict=True))), j) for j, b in good if j != i)
            out[i] = [(j, -s) for s, j in score[:k]]
    return out


def test_neighbours_of_odd_vectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1 + i % 5) for _ in range(6)]) for i in range(300)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # copies of a query: ties by the smaller id
    rows += [(500, None), (520, []), (540, [0.0] * 6), (560, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (580, [float("nan")] * 6), (600, [float("inf")] * 6), (620, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("own")).repartition(4)
    settings = ann.Settings(recall=1.0, block=50, queries=7, leaf=8, branching=4)
    found = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, settings=settings).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows, 20)
    assert set(found) == set(want)
    for i, own in found.items():
        own.sort()
        assert [x for x, *_ in own] == list(range(1, 21))
        assert [x for _, x, _ in own] == [x for x, _ in want[i]]
        assert [x for *_, x in own] == pytest.approx([x for _, x in want[i]])


def test_few_or_no_neighbours(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, -1.0]), (20, [2.0, 0.0])], VECTORS)
    rows = sorted(map(tuple, ann.search(df, F.col("vec_id") % 20 == 0).collect()))
    assert rows == [(0, 1, 20, 2.0), (0, 2, 1, 0.5), (0, 3, 2, 0.0), (20, 1, 0, 2.0), (20, 2, 1, 1.0), (20, 3, 2, 0.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df, F.lit(False)).count() == 0


def test_recall_against_all_pairs(spark):
    sf = "/root/testdata/sf0.1"
    found = {}
    for r in q.op2_ann(spark, sf).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.array(e.embedding.tolist(), float), e.vec_id.to_numpy()
    hits = 0
    for i in ids[ids % 20 == 0]:
        s = x @ x[ids == i][0]
        s[ids == i] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        own = sorted(found[i])
        assert len(own) == 20
        assert [v for *_, v in own] == sorted((v for *_, v in own), reverse=True)
        assert all(abs(v - s[ids == j][0]) < 1e-12 for _, j, v in own)
        hits += len(set(best) & {j for _, j, _ in own})
    assert hits / (20 * len(found)) >= 0.9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_every_list_is_complete(spark, sf):
    found = q.op2_ann(spark, f"/root/testdata/{sf}").groupBy("query_id").agg(F.sort_array(F.collect_list("rank")).alias("ranks")).collect()
    ids = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").filter("vec_id % 20 = 0").count()
    assert len(found) == ids and all(r["ranks"] == list(range(1, 21)) for r in found)


def test_a_list_is_complete_where_the_bound_ends_the_search_at_once(spark):
    """The vectors that set the bound are far apart, and leaves that don't hold them are visited first."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 12)) * rng.choice([0.1, 1, 5], size=(3000, 1))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], VECTORS)
    found = ann.search(df, F.col("vec_id") % 100 == 0, settings=ann.Settings(recall=0.0, sample=300, leaf=8, branching=4, block=200)).groupBy("query_id").count().collect()
    assert len(found) == 30 and {r["count"] for r in found} == {20}


def test_neighbours_are_of_a_querys_own_length(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [0.5, 0.5]), (20, [1.0, 0.0, 0.0]), (21, [2.0, 5.0, 1.0]), (22, [1.0, 1.0, 1.0]), (23, [4.0, 0.0, 0.0]), (40, [7.0])]
    found = sorted(map(tuple, ann.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0).collect()))
    assert found == [(0, 1, 1, 5.0), (0, 2, 2, 1.5), (20, 1, 23, 4.0), (20, 2, 21, 2.0), (20, 3, 22, 1.0)]


def test_a_bound_is_no_score_that_rounding_may_miss():
    """Large norms and products near 0: the bound stands below what any order of summing may give."""
    q = np.array([[1e8, 1e8, 1.0]])
    s = np.array([[1e8, -1e8, x] for x in np.linspace(0, 1, 40)])
    floor = ann.bounds(q, np.array([-1]), s, np.arange(40), 20, 2e8)
    assert floor[0] < np.sort(ann.dots(np.repeat(q, 40, 0), s))[-20]


def test_a_query_visits_a_part_of_clustered_rows():
    """Of 40,000 vectors in 400 clusters fewer than a third are compared, at a recall of 0.9 or more; an odd query widens by itself."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(400, 32))
    x = centres[rng.integers(0, 400, 40_000)] + 0.2 * rng.normal(size=(40_000, 32))
    ids, settings = np.arange(len(x)), ann.Settings(sample=4000)
    picked = rng.permutation(len(x))[:4000]
    norm = float(np.linalg.norm(x, axis=1).max())
    tree = ann.fit(x[picked], norm, settings)
    leaf = tree.assign(x)
    sizes = np.bincount(leaf, minlength=tree.leaves)

    def true(rows):
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -np.inf
        return np.argsort(-s, axis=1)[:, :20]

    tried, asked = ids[:100], ids[100:300]
    floor = lambda rows: ann.bounds(x[rows], rows, x[picked], picked, 20, norm)
    slack = ann.calibrated(tree, x[tried], floor(tried), sizes, 20, [leaf[t].tolist() for t in true(tried)], 0.95)
    visited = tree.visits(x[asked], floor(asked), slack, sizes, 21)
    recall = np.mean([np.isin(leaf[t], v).mean() for t, v in zip(true(asked), visited, strict=True)])
    assert recall >= 0.9
    assert np.mean([sizes[v].sum() for v in visited]) < len(x) / 3
    assert len({len(v) for v in visited}) > 1


# -- vector duplicates


def test_vector_links_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows, base = [], rng.normal(size=(30, 8))
    for i in range(400):
        v = base[i % 30] + rng.normal(size=8) * rng.choice([0.02, 0.1, 0.4])
        rows.append((i, np.float32(v * rng.choice([1e-3, 1.0, 50.0])).tolist(), [0, 1, 1, 1, None][i % 5]))
    rows += [(1000 + i, rows[1][1], 1) for i in range(70)] + [(2000, rows[1][1], None), (2001, rows[1][1], 0)]
    bad = [(3000, None, 1), (3001, [0.0] * 8, 1), (3002, [float("nan")] * 8, 1), (3003, [float("inf")] + [0.0] * 7, 1), (3004, [1.0, None] + [0.0] * 6, 1), (3005, [1.0], 1), (3006, [], 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("own")).repartition(4)
    for settings in (pqdedup.Settings(), pqdedup.Settings(block=16, lists=5, sample=50, parts=3, codes=9), pqdedup.Settings(sample_bytes=8 * 8 * 20)):
        found = {r["vec_id"]: tuple(r)[1:] for r in pqdedup.grouped(df, settings=settings).collect()}
        x = np.array([r[1] for r in rows], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        ids, lab = [r[0] for r in rows], [r[2] for r in rows]
        link = (x @ x.T >= 0.98) & np.array([[a is not None and a == b for b in lab] for a in lab])
        np.fill_diagonal(link, False)
        label = list(range(len(ids)))
        for a, b in zip(*np.nonzero(link), strict=True):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            if old != new:
                label = [new if y == old else y for y in label]
        want = {i: (int(link[k].sum()), ids[label[k]], ids[label[k]] == i) for k, i in enumerate(ids)}
        assert found == want | {b[0]: (0, b[0], True) for b in bad}
        assert sum(n for n, *_ in want.values()) > 4000


def test_a_sample_of_long_vectors_is_bounded_in_bytes():
    assert [pqdedup.Settings().sampled(d) * d * 8 <= 16 << 20 for d in (1, 64, 4096, 1 << 22)] == [True, True, True, False]
    assert (pqdedup.Settings().sampled(64), pqdedup.Settings().sampled(4096), pqdedup.Settings().sampled(1 << 22)) == (16_384, 512, 1)


def test_vector_duplicates_of_no_and_of_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert pqdedup.grouped(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in pqdedup.grouped(spark.createDataFrame([(1, None, 1)], schema)).collect()] == [(1, 0, 1, True)]
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (1, [0.0, 2.0], 1)]
    found = sorted((tuple(r) for r in pqdedup.grouped(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert found == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (2, 1, 1, False), (1, 1, 1, True)], key=repr)


def test_vectors_of_every_length_link(spark):
    rows = [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, [2.0, 4.1], 1), *[(10 + i, [float(i), 1.0, 0.0], 1) for i in range(5)], (20, [1.0, 2.0, 0.0], 1), (21, [5.0], 1), (22, [2.0], 1), (23, [-2.0], 1)]
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pqdedup.grouped(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert [found[i] for i in (1, 2, 3, 20, 21, 22, 23)] == [(2, 1), (2, 1), (2, 1), (0, 20), (1, 21), (1, 21), (0, 23)]


# -- URL filters


def plain_judgement(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.text), len(r.host)), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http:///x", "http://com", "http://COM/", "https://a.com/en/x", "http://example.com/en/", "http://www.example.com/en/1?q#f", "http://WWW.Example.COM/en", "http://x.www.example.com/en/?",
    "http://notexample.com/en/", "http://a.net/es/1", "http://a.net/fr/", "http://net/fr/x", "http://a.net?/fr/", "http://a.net#/fr/", "a://b://c.com/", "http://.com/", "http://a..com/", "http://é.net/es/é", "http://u:p@a.com:80/", "http://a.com:80/x",
    "x\n://a.com/\ny", "http://" + "a." * 500 + "com/" + "p" * 5000,
]


def test_urls_are_judged_as_by_trying_all_rules(spark):
    rules = [*q.RULES, urlfilter.Rule("é.net", "/es/é", "allow"), urlfilter.Rule("a.net", "", "block"), urlfilter.Rule("b.c", "/", "allow"), urlfilter.Rule("b.c", "/", "block")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumns({"host": F.lit("own"), "_host": F.lit("own"), "rule": F.lit(1)})
    found = urlfilter.judged(df, rules)
    assert found.columns == ["page_id", "url", "_host", "host", "path", "rule", "verdict"]
    for r in found.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_judgement(r["url"], rules), r["url"]
    assert urlfilter.judged(spark.createDataFrame([("http://b.c/",)], "url string"), rules).first()["verdict"] == "block"
    assert urlfilter.judged(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urlfilter.judged(df, [], default="block").collect()} == {"block"}


def test_a_long_host_makes_few_probes(tmp_path, monkeypatch):
    """A host of a megabyte, of half a million labels: as many probes as the rules have numbers of labels."""
    (tmp_path / "rules").write_bytes(urlfilter.packed([urlfilter.Rule("com", "/", "block"), urlfilter.Rule("b.example.com", "/x", "allow")]))
    array, asked = urlfilter.Array(str(tmp_path / "rules")), []
    find = urlfilter.Array.find
    monkeypatch.setattr(urlfilter.Array, "find", lambda self, probes: (asked.extend(probes), find(self, probes))[1])
    long = "a." * 500_000
    assert array.judge([long + "com", long + "b.example.com", "com", "b.example.com", "xb.example.com", "org"], ["/", "/xy", "/", "/x", "/x", "/"]) == [("com/", True), ("b.example.com/x", False), ("com/", True), ("b.example.com/x", False), ("com/", True), (None, False)]
    assert sum(map(len, asked)) < 1000


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda s: len(s) % 2)
    rules = [urlfilter.Rule(f"h{i}.com", "/" + "x" * (i % 4), "block" if i % 3 else "allow") for i in range(40)]
    (tmp_path / "r").write_bytes(urlfilter.packed(rules))
    array = urlfilter.Array(str(tmp_path / "r"))
    probes = [f"{r.host}\n{r.path}".encode() for r in rules] + [b"h1.com\n/nope", b"zz"]
    found = array.find(probes)
    assert (found[-2:] == -1).all()
    assert sorted(found[:-2]) == list(range(40))
    assert [r for r, _ in array.judge([r.host for r in rules], [r.path + "yy" for r in rules])] == [r.text for r in rules]


def test_rules_are_checked():
    for r in (urlfilter.Rule("", "/", "block"), urlfilter.Rule("a", "/", "deny")):
        with pytest.raises(ValueError, match="no rule"):
            urlfilter.packed([r])


# -- queries with SQL, and the pipeline


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query(spark, sf_dir, name):
    from tests_support import compare

    compare(spark, sf_dir, q.queries()[name], q.oracle_sql()[name])


def test_a_query_leaves_the_session_as_it_was(spark, sf_dir):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    for run in q.queries().values():
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        assert spark.conf.get(name) == before


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from spindrift.llm.shared import shared_dir

    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    for master, ok in (("local[4]", True), ("local", True), ("local[*]", True), ("spark://x:7077", False), ("local-cluster[3,2,1024]", False), ("yarn", False)):
        context.master = master
        session = SimpleNamespace(conf=conf, sparkContext=context)
        if ok:
            assert shared_dir(session).startswith("file://")
        else:
            with pytest.raises(RuntimeError, match="checkpoint"):
                shared_dir(session)


def test_clear_removes_what_was_written(spark):
    from spindrift.llm.shared import clear, scratch_root, stored

    kept = stored(spark.range(3), "x")
    assert kept.count() == 3
    clear(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def plain_languages(docs, learned):
    """(doc_id, language) of those that zstandard alone tells with a margin."""
    out = {}
    for i, text in docs.items():
        raw = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()).encode()
        size = {}
        for lang, words in learned.items():
            d = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=5)
            coder = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False)
            size[lang] = sum(len(coder.compress(raw[at : at + 1024])) for at in range(0, len(raw), 1024))
        best = min(size, key=lambda k: (size[k], k))
        if raw and (sorted(size.values())[1] - size[best]) / size[best] >= 0.005:
            out[i] = best
    return out


def plain_perplexity(texts, letters, symbols):
    """By the definition of interpolated modified Kneser-Ney four-grams of characters."""
    code = lambda t: [0, 0, 0, *[letters.get(c, symbols - 1) for c in t], 0]
    counts = {4: Counter()}
    for t in texts:
        c = code(t)
        counts[4].update(tuple(c[i - 3 : i + 1]) for i in range(3, len(c)))
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    off = {n: quality.discounts([sum(v == k for v in counts[n].values()) for k in (1, 2, 3, 4)]) for n in counts}
    total, taken = {n: Counter() for n in counts}, {n: Counter() for n in counts}
    for n in counts:
        for g, c in counts[n].items():
            total[n][g[:-1]] += c
            taken[n][g[:-1]] += off[n][min(c, 3) - 1]

    @lru_cache(maxsize=None)
    def p(g):
        n = len(g)
        if not n:
            return 1 / symbols
        if g[:-1] not in total[n]:
            return p(g[1:])
        c = counts[n].get(g, 0)
        return ((c - off[n][min(c, 3) - 1] if c else 0) + taken[n][g[:-1]] * p(g[1:])) / total[n][g[:-1]]

    def perplexity(t):
        c = code(t)
        return math.exp(-sum(math.log(p(tuple(c[i - 3 : i + 1]))) for i in range(3, len(c))) / (len(c) - 3))

    return perplexity


def plain_quality(docs, good, fold):
    """Of docs {doc_id: (lang, text)} those that the thresholds of the good ones keep."""
    often = Counter(c for i in good for c in docs[i][1])
    letters = {c: k + 1 for k, c in enumerate(sorted(often, key=lambda c: (-often[c], c))[:32766])}
    model = {m: plain_perplexity([docs[i][1] for i in good if m in (fold[i], 2)], letters, 32768) for m in (0, 1, 2)}
    at = lambda values, q: sorted(values)[max(0, math.ceil(q * len(values)) - 1)]
    logs = [(docs[i][0], math.log(model[1 - fold[i]](docs[i][1])), len(docs[i][1]) + 1) for i in good]

    def level(own):
        middle = at([x for _, x, _ in own], 0.5)
        return middle, at([(x - middle) * n / (n + 100) for _, x, n in own], 0.995)

    levels = {lang: level([x for x in logs if x[0] == lang]) for lang in {x[0] for x in logs}}
    out = set()
    for i, (lang, t) in docs.items():
        middle, above = levels.get(lang) or level(logs)
        if t and model[2](t) <= math.exp(middle + above * (len(t) + 101) / (len(t) + 1)) * (1 + 1e-9):
            out.add(i)
    return out


def plain_groups_by_shingles(docs):
    """The smallest doc_id of each group of texts whose sets of five-word shingles have a similarity of 0.8 or more."""
    sets = {}
    for i, t in docs.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode())
        sets[i] = {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both and both / len(sets[a] | sets[b]) >= 0.8:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                if old != new:
                    label = {i: new if k == old else k for i, k in label.items()}
    return set(label.values())


def plain_mix(docs):
    """How often each of docs {doc_id: (source, text)} is taken."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (_, t) in docs.items()}
    sources = sorted({s for s, _ in docs.values()})
    total = {s: sum(size[i] for i in docs if docs[i][0] == s) for s in sources}
    target, free = {}, set(sources)
    while free:
        left, weights = sum(total.values()) - sum(target.values()), sum(sources.index(s) % 3 + 1 for s in free)
        share = {s: left * (sources.index(s) % 3 + 1) / weights for s in free}
        over = {s for s in free if share[s] > 3 * total[s]}
        target |= {s: 3 * total[s] for s in over} if over else share
        free = free - over if over else set()
    out = Counter()
    for s in sources:
        whole, upto = int(target[s] // total[s]) if total[s] else 0, 0
        unit = lambda i: int(hashlib.md5(f"17\x1f{i}".encode()).hexdigest()[:13], 16) / 2**52
        for i in sorted((i for i in docs if docs[i][0] == s), key=lambda i: (unit(i), size[i])):
            rest = target[s] - whole * total[s]
            out[i] = whole + (rest > 0 and upto + size[i] / 2 <= rest)
            upto += size[i]
    return +out


def test_pipeline(spark, sf_dir):
    """Each stage's rows against a plain version of it, on what the stage before it has kept."""
    import corpus_pipeline as cp
    from tokenizers import Tokenizer

    from spindrift.llm.shared import stored

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, kept = documents, {}
    for name, stage in cp.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "test")
        assert docs.columns == documents.columns, name
        kept[name] = docs.collect()
    every = {r["doc_id"]: r["text"] for r in documents.collect()}

    told = {r["doc_id"]: r["lang"] for r in kept["language ID"]}
    assert told == plain_languages(every, langid.learn(documents.filter(~q.held_out())))
    assert len(told) > 0.95 * len(every)

    texts = {i: (lang, every[i]) for i, lang in told.items()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().groupby("doc_id").agg({"quality": "min", "toxic": "max"})
    good = [i for i in texts if i in labels.index and labels.quality[i] == 1 and not labels.toxic[i]]
    fold = {r["doc_id"]: r["f"] for r in documents.select("doc_id", quality.fold(F.col("text")).alias("f")).collect()}
    after = {r["doc_id"] for r in kept["quality classifier"]}
    assert after == plain_quality(texts, good, fold)

    single = {r["doc_id"] for r in kept["SimHash near-dedup"]}
    assert single == plain_groups_by_shingles({i: every[i] for i in after})

    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    times = Counter(r["doc_id"] for r in kept["mixing"])
    assert times == plain_mix({i: (source[i], every[i]) for i in single})

    coder = Tokenizer.from_file(q.tokenizer())
    coder.encode_special_tokens = True
    ids = {i: [*coder.encode(every[i], add_special_tokens=False).ids, 0] for i in times}
    seen, by = {i: Counter() for i in times}, {}
    for r in cp.run(spark, sf_dir).collect():
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]) == (part, len(ids[r["doc_id"]]))
        seen[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(seen[i] == Counter({k: n for k in range(len(ids[i]))}) for i, n in times.items())
    assert sorted(by) == list(range(len(by)))
    for s, parts in by.items():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) == 1024 or s == max(by)


def test_pipeline_of_odd_documents(spark, tmp_path):
    import corpus_pipeline as cp

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "words of a text " * 40, "en", None, 1), (2, "words of a text " * 40, "en", None, 1), (3, "x " * 50_000, None, "a", 2), (4, "ein anderer Text hier " * 9, "de", "b", 3)]
    labels = spark.createDataFrame([(2, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    for name, some in (("odd", rows), ("empty", [])):
        spark.createDataFrame(some, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
        found = cp.run(spark, str(tmp_path / name))
        assert found.columns == ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        # Texts without letters go; of the repeated row one stays; a mix of these may leave some of them out.
        assert {r["doc_id"] for r in found.collect()} <= ({2, 3, 4} if some else set())
        assert bool(some) == bool(found.count())

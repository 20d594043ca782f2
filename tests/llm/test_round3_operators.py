"""Dimension merge, cross-tokenizer alignment, quality rules."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spindrift.llm import alignment, dimension, fertility, packing, quality, subwords
from spindrift.llm import queries as q

CHANGES = "change_id long, client_id long, seq long, op string, at long, segment string, balance long, version string, slice int"


def versions(rows, inherit):
    """(client, version) to the version, by walking through each client's changes."""
    out = {}
    rows = [r for r in set(rows) if r[4] is not None]
    null_last, null_first = (lambda x: (x is None, x or 0)), (lambda x: (x is not None, x or type(x)()) if x is not None else (False,))
    for client in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == client]
        by_seq = defaultdict(list)
        for r in own:
            by_seq[r[2]].append(r)
        kept = [min(rs, key=lambda r: (null_last(r[0]), r[4], *[null_first(x) for x in (r[3], r[5], r[6])])) for rs in by_seq.values()]
        by_time = defaultdict(list)
        for r in kept:
            by_time[r[4]].append(r)
        state, found = None, []
        for t in sorted(by_time):
            r = max(by_time[t], key=lambda r: null_first(r[2]))
            old = state
            if r[3] == "D":
                state = (True, None, None)
            elif r[3] == "I" or (r[3] == "U" and not (inherit and state)):
                state = (False, r[5], r[6])
            elif r[3] == "U":
                state = (False, *[new if new is not None else had for new, had in zip((r[5], r[6]), state[1:])])
            if state != old:
                found.append((t, state, r[2]))
        for i, (t, state, seq) in enumerate(found):
            until = found[i + 1][0] if i + 1 < len(found) else None
            n = len({r[0] for r in own if r[0] is not None and r[4] >= t and (until is None or r[4] < until)})
            out[client, i + 1] = (t, until, *state, seq, n)
    return out


def merged(df, settings):
    found = dimension.merge(df, "client_id", F.col("at"), "seq", "change_id", "op", {"segment": F.col("segment"), "balance": F.col("balance")}, settings)
    assert found.columns == ["client_id", "version", "valid_from", "valid_to", "is_deleted", "segment", "balance", "first_seq", "n_changes"]
    rows = found.collect()
    out = {(r[0], r[1]): tuple(r[2:]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed,inherit,span,slices,crowd", [(1, False, 50, (7, 1), 3), (2, True, 50, (20, 5, 1), 4), (3, True, 300, (7, 1), 100), (4, False, 300, (1000, 10), 100), (5, True, 40, (4, 2), 1)])
def test_versions_are_those_of_a_walk(spark, seed, inherit, span, slices, crowd):
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        client = rng.choice([1, 1, 1, 2, 3, None, *range(10, 60)])
        change = rng.choice([i, i, i, rng.randrange(900), None])
        rows.append((change, client, rng.choice([rng.randrange(400), rng.randrange(5), None]), rng.choice("DIUUUUUx") if rng.random() < 0.98 else None, rng.choice([rng.randrange(-span, span), rng.randrange(3)]), rng.choice(["a", "b", None, None]), rng.choice([5, None]), "clash", 1))
    rows += [(rng.randrange(900), 7, None, "U", None, "a", 1, "", 1)] + rng.choices(rows, k=100)
    df = spark.createDataFrame(rows, CHANGES).repartition(5)
    assert merged(df, dimension.Settings(inherit, slices, crowd)) == versions(rows, inherit)


def test_versions_of_no_rows_and_of_one_instant(spark):
    empty = spark.createDataFrame([], CHANGES)
    assert merged(empty, dimension.Settings()) == {}
    assert merged(spark.createDataFrame([(1, 1, 1, "U", None, "a", 1, "", 1)], CHANGES), dimension.Settings()) == {}
    # Many changes at one instant are one version, dropped ones counted.
    rows = [(i, 1, i, "U", 5, "a", i, "", 1) for i in range(200)]
    assert merged(spark.createDataFrame(rows, CHANGES), dimension.Settings(crowd=10)) == {(1, 1): (5, None, False, "a", 199, 199, 200)}


def test_an_inherited_value_reaches_over_many_slices(spark):
    """From an insert over updates that leave it null, and never over a delete."""
    day = 24 * 3_600_000_000
    rows = [(1, 1, 1, "I", 0, "a", None, "", 1), (2, 1, 2, "U", 40 * day, None, 7, "", 1), (3, 1, 3, "U", 80 * day, None, None, "", 1), (4, 1, 4, "D", 90 * day, None, None, "", 1), (5, 1, 5, "U", 120 * day, None, 7, "", 1)]
    found = merged(spark.createDataFrame(rows, CHANGES), dimension.Settings(inherit=True))
    assert [found[1, v][:5] for v in (1, 2, 3, 4)] == [(0, 40 * day, False, "a", None), (40 * day, 90 * day, False, "a", 7), (90 * day, 120 * day, True, None, None), (120 * day, None, False, None, 7)]
    assert found[1, 2][6] == 2
    stay = merged(spark.createDataFrame(rows, CHANGES), dimension.Settings())
    assert [v[2:5] for _, v in sorted(stay.items())] == [(False, "a", None), (False, None, 7), (False, None, None), (True, None, None), (False, None, 7)]


# -- Alignment

DOCS = "doc_id long, text string, lang string, source string, key string, block string, a int, place string"

#: Texts whose tokens are hard to tell by words, or don't give their bytes.
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n b", "a \nb", "\n", "\t\tx", "don't we'll 'tis", "<|endoftext|> x <|endoftext|>", "<s> </s> <unk> <0x41>", "a▁b c", "▁",
    "日本語のテキスト です", "naïve café ﬁ １２", "🤷🏽 👩‍👩‍👧 x", "x" * 3000, "ab" * 2500 + " y", "=" * 700 + " z", "\u3000x \u00a0 y", "e\u0301 é", "0x1234567890abcdef " * 40, "the cat sat on the mat " * 60, "a\x00b", "\u200b \u2009 \u2028 z", "\r\n \r\n", "tail\t",
]


@pytest.fixture(scope="module")
def vocabularies():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(q.tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=q.pieces())


def byte_of():
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, n = {chr(b): b for b in shown}, 256
    for b in range(256):
        if b not in shown:
            table[chr(n)] = b
            n += 1
    return table


def groups_of(text, vocabularies):
    """[(a ids, b ids)] of a text, by walking along both lists."""
    if not text:
        return []
    a, b = vocabularies
    table = byte_of()
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ba = [bytes(table[c] for c in a.id_to_token(i)) for i in ia]
    bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ib for p in [b.id_to_piece(i)]]
    if b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
        return []
    out, x, y, end_x, end_y, own = [], 0, 0, 0, 0, ([], [])
    while x < len(ia) or y < len(ib):
        if end_x <= end_y:
            own[0].append(ia[x])
            end_x, x = end_x + len(ba[x]), x + 1
        else:
            own[1].append(ib[y])
            end_y, y = end_y + len(bb[y]), y + 1
        if end_x == end_y:
            out.append(own)
            own = ([], [])
    return out


def alignments(texts, vocabularies):
    """(n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of each text."""
    groups = [groups_of(t, vocabularies) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for own in links for p in own)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [
        (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()), ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g), sum(n for p, n in own.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in own.items()))
        for g, own in zip(groups, links, strict=True)
    ]


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = [" ", " ", " ", " ", "\n", "\t", "  ", "the", "Ünder", "naïve", "日", "9", "1234", "'s", "foo_bar", "....", "▁", "\u00a0", "xyzzy", "E", "🤷", "http://a.b/c?d"]
    return ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(n)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


@pytest.mark.parametrize("settings", [alignment.Settings(), alignment.Settings(slice_bytes=300, crowd=2, heavy=5, full=3)])
def test_alignments_are_those_of_a_walk(spark, vocabularies, settings):
    texts = TEXTS + random_texts(150, 5) + random_texts(20, 5)
    rows = [(i if i % 9 else None, t, "x", "y", "k", "b", 1, "p") for i, t in enumerate(texts)]
    found = alignment.aligned(spark.createDataFrame(rows, DOCS).repartition(3), q.tokenizer(), q.pieces(), settings=settings).select("doc_id", *COLUMNS)
    expected = [(r[0], *e) for r, e in zip(rows, alignments(texts, vocabularies), strict=True)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_alignment_of_no_rows_and_of_texts_without_tokens(spark):
    empty = spark.createDataFrame([], DOCS)
    assert alignment.aligned(empty, q.tokenizer(), q.pieces()).columns == ["doc_id", *COLUMNS]
    assert alignment.aligned(empty, q.tokenizer(), q.pieces()).count() == 0
    none = spark.createDataFrame([(1, None, "", "", "", "", 1, ""), (1, "", "", "", "", "", 1, ""), (2, "x▁y", "", "", "", "", 1, "")], DOCS)
    assert {tuple(r[1:]) for r in alignment.aligned(none, q.tokenizer(), q.pieces()).collect()} == {(0, 0, 0, 0, "", 0, 0)}


def test_alignment_query_against_a_walk(spark, sf_dir, vocabularies):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in q.op11_alignment(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for d, e in zip(docs, alignments([d["text"] for d in docs], vocabularies), strict=True):
        r = found[d["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == (*e[:4], *e[5:])
        assert r["groups_sha256"] == (hashlib.sha256(e[4].encode()).hexdigest() if e[4] else "")


def test_fast_ids_are_the_vocabularys(vocabularies):
    """Of texts by their words, and of each text as a whole."""
    import pyarrow as pa

    texts = [t for t in TEXTS + random_texts(300, 8) if t]
    for by, plain in ((subwords.BytePairs(q.tokenizer()), lambda t: vocabularies[0].encode(" " + t, add_special_tokens=False).ids), (subwords.Pieces(q.pieces()), vocabularies[1].encode)):
        assert by.whole(texts) == [plain(t) for t in texts]
        words = subwords.Words(pa.array(texts))
        ids, counts = words.encode(by)
        cuts = [0, *counts.cumsum().tolist()]
        got = defaultdict(list)
        for t, u in zip(words.text.tolist(), words.unit.tolist(), strict=True):
            got[t] += ids[cuts[u] : cuts[u + 1]].tolist()
        assert [got[i] for i in range(len(texts))] == [plain(t) for t in texts]


# -- Quality rules

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def token_measures(text, vocabularies):
    a, b = vocabularies
    ids = b.encode(text or "")
    if not ids:
        return None
    shares = [n / len(ids) for n in Counter(ids).values()]
    return len(text) / len(a.encode(" " + text, add_special_tokens=False).ids), len(text) / len(ids), sum(map(b.is_byte, ids)) / len(ids), -sum(x * math.log2(x) for x in shares), len(ids)


def verdicts(rows, vocabularies, s):
    """(base counts, measures, base_failed, outside, kept) of rows (text, language or script)."""
    told = []
    for text, of in rows:
        base = base_counts(text)
        told.append((base, token_measures(text, vocabularies), base[0] < s.least_words or 100 * base[4] > s.most_repeated * base[0], of))
    length = lambda m: int(math.log2(m[4]) / 2)
    groups = defaultdict(list)
    for _, m, failed, of in told:
        if m and not failed:
            groups[of, length(m)].append(m)
            groups[of, None].append(m)
    bands = {}
    for k, ms in groups.items():
        if len(ms) >= s.least_texts:
            for i in range(4):
                low, mid, high = (sorted(m[i] for m in ms)[max(0, math.ceil(p * len(ms)) - 1)] for p in (0.25, 0.5, 0.75))
                reach = max(s.fence * (high - low), s.fallback_slack if i == 2 else s.slack * mid)
                bands[k, i] = low - reach, high + reach
    out = []
    for base, m, failed, of in told:
        outside = []
        for i, name in enumerate(fertility.MEASURES):
            band = m and (bands.get(((of, length(m)), i)) or bands.get(((of, None), i)))
            if band and not band[0] <= m[i] <= band[1]:
                outside.append(name)
        out.append((base, m, failed, outside, not failed and not outside))
    return out


def agree(found, expected):
    base, m, failed, outside, kept = expected
    assert tuple(found[c] for c in BASE) == base
    assert [found[c] for c in fertility.MEASURES] == ([None] * 4 if m is None else [pytest.approx(x, abs=1e-9) for x in m[:4]])
    assert (found["base_failed"], found["outside"], found["kept"]) == (failed, outside, kept)


@pytest.mark.parametrize("settings", [fertility.Settings(least_texts=20, fence=0.6, slack=0.02), fertility.Settings(slice_bytes=200, least_words=5, least_texts=8, fence=0.5, slack=0.01)])
def test_rules_are_those_of_plain_counting(spark, vocabularies, settings):
    rng = random.Random(4)
    vocabulary = ["alpha", "beta", "gamma,", "délta", "$$$", "日本", "&&", "x\ny", "zz zz"]
    texts = TEXTS + ["\n".join(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 9))) for _ in range(rng.randrange(30))) for _ in range(150)]
    texts += ["one two three " * 30 + "x", "a b c d a b c", "a a a a", "l\nl\n\n \n \nl \nl", "a\x1cb a\x85b"]
    rows = [(i if i % 7 else None, t, rng.choice(["en", "en", "fr", None]), "x", "k", "b", 1, "p") for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key string, kept string, of int, entropy string").repartition(3)
    found = fertility.judged(df, q.tokenizer(), q.pieces(), settings=settings)
    scripts = [fertility._script(r[1] or "") for r in rows]
    expected = verdicts([(r[1], f"language {r[2]}" if r[2] else f"script {s}" if s else "none") for r, s in zip(rows, scripts, strict=True)], vocabularies, settings)
    assert 20 < sum(e[4] for e in expected) < len(rows) - 20 and sum(bool(e[3]) for e in expected) > 10
    order = lambda k, lang, base: (repr(k), repr(lang), base)
    got = sorted(found.collect(), key=lambda r: order(r["doc_id"], r["lang"], tuple(r[c] for c in BASE)))
    want = sorted(zip(rows, expected, strict=True), key=lambda x: order(x[0][0], x[0][2], x[1][0]))
    assert len(got) == len(want)
    for g, (r, e) in zip(got, want, strict=True):
        assert g["doc_id"] == r[0]
        agree(g, e)


def test_rules_of_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fertility.judged(empty, q.tokenizer(), q.pieces()).count() == 0


def test_scripts():
    assert [fertility._script(t) for t in ("abc é", "Привет a", "日本の語", "", "12 _", "ⴰⴱ", "aя", "한글 x")] == ["Latin", "Cyrillic", "Han", None, None, "Other", "Latin", "Hangul"]


def test_rules_query_against_plain_counting(spark, sf_dir, vocabularies):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    found = {r["doc_id"]: r for r in q.op12_fertility(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    expected = verdicts([(d["text"], f"language {d['lang']}" if d["lang"] else f"script {fertility._script(d['text'] or '')}") for d in docs], vocabularies, fertility.Settings())
    for d, e in zip(docs, expected, strict=True):
        agree(found[d["doc_id"]], e)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [found[i] for i, quality in labels.items() if quality == 1 and i in found and not found[i]["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good)


# -- Packing and quality


def test_a_rare_source_sends_whole_documents(spark):
    """Beside 10 ** 11 tokens of another source: each when its deficit covers it, in no more runs than documents and windows."""
    big = [(i, (i % 97) / 97, "big", 10**8) for i in range(1000)]
    rare = [(2000 + i, i / 10, "rare", 1000 - i) for i in range(5)]
    found = {r["_row"]: r["_runs"] for r in packing.positions(spark.createDataFrame(big + rare, "_row long, _u double, _source string, _n long")).filter("_row >= 2000 OR _row < 3").collect()}
    total = 10**11 + sum(r[3] for r in rare)
    sent = 0
    for row, _, _, n in rare:
        assert [(x["from"], x["size"]) for x in found[row]] == [(0, n)]
        sent += n
        share = found[row][0]["at"] / total  # the share of the stream that has gone by is that of the source, to a window
        assert abs(share - sent / (total - 10**11)) < 1e-5
    assert len(found[0]) <= 10**8 // 65_000 + 2


@pytest.mark.parametrize("rows", [1, 700, 1500, 10_000])
def test_blocks_do_not_depend_on_batches(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    docs = docs.union(docs).coalesce(1)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality", "toxic")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        found = quality.judged(docs, labels, settings=quality.Settings(block=256 << 10)).groupBy("doc_id").agg(F.count("*").alias("n"), F.min("perplexity").alias("low"), F.max("perplexity").alias("high")).collect()
    finally:
        spark.conf.set(name, before)
    assert len(found) == 1000 and all(r["n"] == 2 and (r["low"] is None or r["low"] == pytest.approx(r["high"])) for r in found)


def test_shuffle_files_of_finished_steps_go(spark):
    import os
    import time

    from spindrift.llm.shared import passing

    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled():
        return {f for d in dirs for *_, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = shuffled()
    with passing(spark):
        spark.range(50_000).repartition(5, "id").groupBy(F.col("id") % 100).count().collect()
        made = shuffled() - before
        assert made
    for _ in range(100):
        if not made & shuffled():
            break
        time.sleep(0.1)
    assert not made & shuffled()

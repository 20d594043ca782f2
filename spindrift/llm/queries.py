"""The operators over their whole test tables, one query each, and the SQL that states the rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import alignment, ann, dimension, fertility, langid, mixing, packing, pqdedup, quality, sharding, simhash, urlfilter, warc
from spindrift.llm.shared import scratch, stored

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def held_out(key: str = "doc_id"):
    """Whether a document is kept from learning; a null key is."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record a page, written and read back; a revisit's digest and length are those that it states of the full payload."""
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    found = warc.read(spark, path)
    number = lambda c: F.regexp_extract(c, r"^<urn:x-record:(-?\d+)>$", 1).try_cast("long")
    revisit = F.col("type") == "revisit"
    return found.select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.col("stated_bytes").try_cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((c.v >> {}) & 31 AS INTEGER) + 1, 1)"
_SQL["op1_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex FROM p),
c AS (SELECT hex, i, CAST('0x' || substr(hex, 10 * i + 1, 10) AS BIGINT) AS v FROM (SELECT DISTINCT hex FROM h), range(4) AS r(i)),
b AS (SELECT hex, string_agg({" || ".join(_DIGIT.format(5 * k) for k in range(7, -1, -1))}, '' ORDER BY i) AS payload_digest FROM c GROUP BY hex),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < first THEN first END AS refers_to
FROM m JOIN b USING (hex)
"""


@query
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    return ann.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's perplexity under the model of the documents labelled good, and whether its language's threshold keeps it."""
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "lang", "text"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return stored(quality.judged(docs, labels).select("doc_id", "lang", "perplexity", "symbols", "threshold", "keep"), "quality", 1000)


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionaries of the documents that aren't held out, then every whole text's language."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learned = langid.learn(docs.filter(~held_out()))
    found = langid.identify(docs.select("doc_id", "text"), learned)
    return stored(found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected"), "languages", 1000)


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at three differing bits or fewer."""
    found = simhash.grouped(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's part in the mix."""
    found = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"), keep_text=False)
    return found.select("doc_id", "size", "source_size", "target", "taken", "repeats")


#: The water level is the largest of those at which the next source isn't above its cap; documents are drawn in the order of 52 bits of an MD5.
_SQL["op6_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST(CAST('0x' || substr(md5('17' || chr(31) || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
    FROM w WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST)),
t AS (SELECT *, max(CASE WHEN cap >= lev * weight THEN lev END) OVER () AS best FROM l),
g AS (SELECT source, source_size, least(cap, best * weight) AS target, CASE WHEN source_size > 0 THEN floor(least(cap, best * weight) / source_size) ELSE 0 END AS whole FROM t),
r AS (SELECT d.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT *, CAST(whole + CASE WHEN rest > 0 AND upto + size / 2.0 <= rest THEN 1 ELSE 0 END AS INTEGER) AS repeats FROM r)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(repeats * size AS BIGINT) AS taken, repeats FROM c
"""

@query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component among the vectors of its label."""
    return pqdedup.grouped(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


_SQL["op9_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), m AS (SELECT a, least(a, min(b)) AS c FROM r GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(m.c, e.vec_id) AS component_id, coalesce(m.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN m ON m.a = e.vec_id
"""

RULES = [
    urlfilter.Rule("com", "/", "allow"),
    urlfilter.Rule("example.com", "/en/", "block"),
    urlfilter.Rule("www.example.com", "/en/", "allow"),
    urlfilter.Rule("net", "/es/", "block"),
    urlfilter.Rule("net", "/fr/", "block"),
]


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the rules; allowed where none fits."""
    return urlfilter.judged(table(spark, sf_dir, "pages", "page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


_SQL["op10_url_filter"] = r"""
WITH p AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f AS (SELECT h.*, r.rule_host || r.rule_path AS rule, r.verdict, row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS i
    FROM h LEFT JOIN r ON (h.host = r.rule_host OR ends_with(h.host, '.' || r.rule_host)) AND starts_with(h.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE i = 1
"""


def tokenizer() -> str:
    """The public vocabulary file that the packing query reads."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, with the digest of their ids."""
    found = packing.pack(table(spark, sf_dir, "documents", "doc_id", "source", "text"), tokenizer())
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard along the curve through language, source and size."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    docs = docs.select("doc_id", "lang", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    found = sharding.shard(docs, {"lang": F.col("lang"), "source": F.col("source"), "size": F.col("size")})
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def _curve(dims: int, bits: int) -> str:
    """The steps of hilbert() as nested SELECTs over q, whose columns x0, x1, ... are the point; the index is h."""
    of = lambda new: ", ".join(f"{new.get(i, f'x{i}')} AS x{i}" for i in range(dims))
    sql = "q"
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(dims):
            hit, swap = f"(x{i} & {q}) <> 0", f"(xor(x0, x{i}) & {q - 1})"
            flip = f"CASE WHEN {hit} THEN xor(x0, {q - 1}) ELSE xor(x0, {swap}) END"
            sql = f"(SELECT * REPLACE ({of({0: flip} | ({i: f'CASE WHEN {hit} THEN x{i} ELSE xor(x{i}, {swap}) END'} if i else {}))}) FROM {sql})"
    for i in range(1, dims):
        sql = f"(SELECT * REPLACE ({of({i: f'xor(x{i}, x{i - 1})'})}) FROM {sql})"
    turn = "0"
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn = f"xor({turn}, CASE WHEN (x{dims - 1} & {q}) <> 0 THEN {q - 1} ELSE 0 END)"
    sql = f"(SELECT *, {turn} AS t FROM {sql})"
    places = [f"((xor(x{i}, t) >> {b}) & 1) << {b * dims + dims - 1 - i}" for b in range(bits) for i in range(dims)]
    return f"(SELECT *, {' + '.join(f'({p})' for p in places)} AS h FROM {sql})"


_STEP = "CAST(coalesce(sum(n) OVER (ORDER BY {0} ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 32 // sum(n) OVER () AS BIGINT)"
_STEPS = ", ".join(f"s{i} AS (SELECT {c}, {_STEP.format(c)} AS x{i} FROM (SELECT {c}, count(*) AS n FROM d GROUP BY {c}))" for i, c in enumerate(("lang", "source", "size")))

#: In a cell of the curve documents stand in the order of 52 bits of an MD5; whole numbers cut the runs. DuckDB has no CRC-32, so a table of its 256 remainders is made and each byte folded in.
_SQL["op8_sharding"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, source, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes,
    CAST(CAST('0x' || substr(md5('29' || chr(31) || coalesce(CAST(doc_id AS VARCHAR), chr(0))), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM documents),
g(i, k, x) AS (SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END FROM g WHERE k < 8),
f AS (SELECT list(x ORDER BY i) AS folds FROM g WHERE k = 8),
{_STEPS},
q AS (SELECT doc_id, d.size, u, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(bytes, lambda b: CAST('0x' || b AS BIGINT))), lambda c, b: xor(c >> 8, folds[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295) AS crc, x0, x1, x2
    FROM d, f, s0, s1, s2 WHERE d.lang IS NOT DISTINCT FROM s0.lang AND d.source IS NOT DISTINCT FROM s1.source AND d.size = s2.size),
r AS (SELECT *, row_number() OVER (ORDER BY h, u, doc_id) - 1 AS i, count(*) OVER () AS n FROM {_curve(3, 5)})
SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(i * 16 // n AS INTEGER) AS shard, CAST(i - (i * 16 // n * n + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, CAST(h AS BIGINT) AS hilbert FROM r
"""


_SHIFT = 240 * 3600 * 1_000_000


@query
def op13_dimension_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of every client. As the contract has it, an update's nulls stay null, so that only equal states are stitched."""
    changes = spark.read.parquet(f"{sf_dir}/client_changes.parquet")
    early = F.crc32(F.col("change_id").cast("string").cast("binary")) % 3 == 0
    at = dimension.micros(changes, "valid_at") - F.when(early, F.lit(_SHIFT)).otherwise(F.lit(0))
    balance = F.col("balance")
    cents = F.when(balance - balance == 0, F.floor(100 * balance + 0.5).cast("long"))
    found = dimension.merge(changes, "client_id", at, "seq", "change_id", "op", {"source": F.col("source"), "segment": F.col("segment"), "city": F.col("city"), "balance_cents": cents})
    seconds = lambda c: F.floor(F.col(c) / 1_000_000).cast("long")
    return found.withColumn("valid_from", seconds("valid_from")).withColumn("valid_to", seconds("valid_to"))


_STATE = ["is_deleted", "source", "segment", "city", "balance_cents"]

#: DuckDB has no CRC-32: as in op8_sharding.
_SQL["op13_dimension_merge"] = f"""
WITH RECURSIVE g(i, k, x) AS (SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256) UNION ALL SELECT i, k + 1, CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END FROM g WHERE k < 8),
f AS (SELECT list(x ORDER BY i) AS folds FROM g WHERE k = 8),
d AS (SELECT DISTINCT * FROM client_changes WHERE valid_at IS NOT NULL),
e AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(change_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c >> 8, folds[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295) AS crc FROM d, f),
c AS (SELECT *, epoch_us(valid_at) - CASE WHEN crc % 3 = 0 THEN {_SHIFT} ELSE 0 END AS moment, CASE WHEN isfinite(balance) THEN CAST(floor(100 * balance + 0.5) AS BIGINT) END AS cents FROM e),
p AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY client_id, seq ORDER BY change_id NULLS LAST, moment, op NULLS FIRST, source NULLS FIRST, segment NULLS FIRST, city NULLS FIRST, cents NULLS FIRST) = 1),
q AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY client_id, moment ORDER BY seq DESC NULLS LAST) = 1),
s AS (SELECT client_id, moment, seq, op = 'D' AS is_deleted, CASE WHEN op <> 'D' THEN source END AS source, CASE WHEN op <> 'D' THEN segment END AS segment, CASE WHEN op <> 'D' THEN city END AS city, CASE WHEN op <> 'D' THEN cents END AS balance_cents FROM q WHERE op IN ('D', 'I', 'U')),
t AS (SELECT *, lag(moment) OVER o IS NULL OR {" OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER o" for c in _STATE)} AS starts FROM s WINDOW o AS (PARTITION BY client_id ORDER BY moment)),
v AS (SELECT *, lead(moment) OVER (PARTITION BY client_id ORDER BY moment) AS until, row_number() OVER (PARTITION BY client_id ORDER BY moment) AS version FROM t WHERE starts)
SELECT v.client_id, CAST(version AS INTEGER) AS version, v.moment // 1000000 AS valid_from, until // 1000000 AS valid_to, v.{", v.".join(_STATE)}, v.seq AS first_seq, count(DISTINCT c.change_id) AS n_changes
FROM v LEFT JOIN c ON c.client_id IS NOT DISTINCT FROM v.client_id AND c.moment >= v.moment AND (until IS NULL OR c.moment < until)
GROUP BY ALL
"""


def pieces() -> str:
    """The public model file of pieces that the alignment and the rules on tokens read."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two vocabularies, linked where they stand for the same bytes, with the digest of its groups."""
    rows = alignment.encoded(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", tokenizer(), pieces())
    groups = F.col("groups")
    rows = rows.withColumn("groups", F.when(groups == "", "").otherwise(F.sha2(groups, 256))).withColumnRenamed("groups", "groups_sha256")
    return alignment.counted(rows, "doc_id")


@query
def op12_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text's base counts, and whether what its tokens tell lies in the bands of its language."""
    found = fertility.judged(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), tokenizer(), pieces())
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*base, "n_tokens_a", "n_tokens_b", *fertility.MEASURES, "outside")

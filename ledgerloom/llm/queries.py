"""The operators of this package applied to whole test tables, and the same results as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    divergence,
    mil_classifier,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_rules,
    sharding,
    suffix_dedup,
    syncmers,
    text,
    token_files,
    vector_codes,
    warc,
)
from ledgerloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op1_attention_mil(spark, sf):
    docs = _documents(spark, sf)
    model = mil_classifier.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scored = mil_classifier.score(docs, model)
    return scored.select("doc_id", mil_classifier.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "passage")


@query
def op2_bm25_packing(spark, sf):
    pieces = packing.pack(_documents(spark, sf))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_closed_syncmers(spark, sf):
    return syncmers.edited_fingerprints(_documents(spark, sf))


@query
def op4_warc_segments(spark, sf):
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf}/pages.parquet"), path)
    return warc.read_pages(spark, path)


ORACLES["op4_warc_segments"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages),
d AS (SELECT *, sha1(h) AS x FROM p),
g AS (SELECT *, list_transform(range(4), lambda i: CAST('0x' || substr(x, CAST(10 * i + 1 AS BIGINT), 10) AS BIGINT)) AS v FROM d)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((v[k // 8 + 1] >> (35 - 5 * (k % 8))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to FROM g"""


@query
def op5_deep_shallow_dedup(spark, sf):
    cleaned = suffix_dedup.without_repeats(_documents(spark, sf))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_quality_cascade(spark, sf):
    judged = quality_rules.judged(_documents(spark, sf).select("doc_id", "text"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "row.doc_id",
        *quality_rules.BASE_FEATURES,
        base_failed.alias("base_failed"),
        (~base_failed & F.col("rejected_by").isNull()).alias("kept"),
    )


ORACLES["op6_quality_cascade"] = r"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
f AS (SELECT w.doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
  length(regexp_replace(t, '\P{Lu}', '', 'g')) AS n_upper FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words
       OR word_chars > 14 * n_words OR 2 * n_upper > word_chars) AS kept FROM b"""


@query
def op7_systematic_mix(spark, sf):
    docs = _documents(spark, sf).select("doc_id", "source", text.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(docs, size=F.col("words"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query
def op8_semi_markov_pii(spark, sf):
    docs = _documents(spark, sf)
    found = pii.detect(docs, pii.fit(docs))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op9_hypergeometric_shards(spark, sf):
    body = F.coalesce("text", F.lit(""))
    docs = _documents(spark, sf).select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
    )
    sharded = sharding.shuffle_into_shards(docs, text="text_crc32")
    return sharded.select("row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_ngram_join(spark, sf):
    return ngram_join.near_duplicate_groups(_documents(spark, sf))


ORACLES["op10_ngram_join"] = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
    list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM x JOIN x y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (SELECT c.a, c.b FROM c JOIN s t ON c.a = t.doc_id JOIN s u ON c.b = u.doc_id WHERE 100 * c.n >= 80 * (len(t.s) + len(u.s) - c.n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS m FROM s UNION SELECT e.b, r.m FROM r JOIN e ON r.d = e.a WHERE r.m < e.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, q.component_id
FROM s JOIN (SELECT d, min(m) AS component_id FROM r GROUP BY d) q ON s.doc_id = q.d"""


@query
def op11_walsh_vector_codes(spark, sf):
    return vector_codes.compressed(spark.read.parquet(f"{sf}/embeddings.parquet"))


def _vector_code_sql(rounds: int = 6) -> str:
    """Every round as two steps: parts to their nearest entries, entries to the floor of their parts' mean."""
    steps = [
        r"""k AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS r,
  list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "p AS (SELECT r, j, v[j * len(v) // 8 + 1 : (j + 1) * len(v) // 8] AS q FROM k, (SELECT unnest(range(8)) AS j))",
        "c0 AS (SELECT j, r - 1 AS e, q AS c FROM p WHERE r <= 16)",
    ]
    for i in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"a{i} AS (SELECT r, p.j, min({distance} * 16 + e) AS m FROM p JOIN c{i} ON p.j = c{i}.j GROUP BY r, p.j)")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT j, e, place, sum(x) AS s, count(*) AS n FROM (SELECT p.j, m % 16 AS e, unnest(q) AS x,
  unnest(range(len(q))) AS place FROM p JOIN a{i} ON p.r = a{i}.r AND p.j = a{i}.j) GROUP BY j, e, place)""")
            steps.append(f"u{i} AS (SELECT j, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS c FROM s{i} GROUP BY j, e)")
            steps.append(f"c{i + 1} AS (SELECT o.j, o.e, coalesce(u.c, o.c) AS c FROM c{i} o LEFT JOIN u{i} u ON o.j = u.j AND o.e = u.e)")
    steps += [
        f"f AS (SELECT r, string_agg(printf('%02x', CAST(m % 16 AS INTEGER)), '' ORDER BY j) AS code, CAST(sum(m // 16) AS BIGINT) AS error FROM a{rounds} GROUP BY r)",
        f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY j, e)) AS h FROM c{rounds})",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT k.vec_id, f.code, f.error, CAST(sum(f.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT h FROM h) AS codebooks_sha256 FROM k JOIN f ON k.r = f.r"""


ORACLES["op11_walsh_vector_codes"] = _vector_code_sql()


@query
def op12_patched_frame_files(spark, sf):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_documents(spark, sf), path)
    return token_files.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op13_source_divergence(spark, sf):
    return divergence.audit(_documents(spark, sf))


ORACLES["op13_source_divergence"] = r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
w AS (SELECT r, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
      FROM (SELECT r, lang, source, unnest(t) AS x FROM d)),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, source, w.term),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
x AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
  CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (t.n + 2 * v.v) AS BIGINT) AS p,
  CAST(1 + CAST(1000000000 AS HUGEINT) * (k.n + 2) // (v.n + 2 * v.v) AS BIGINT) AS q
  FROM t JOIN v ON t.lang = v.lang JOIN k ON t.lang = k.lang LEFT JOIN c ON t.lang = c.lang AND t.source = c.source AND k.term = c.term),
s AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
      FROM x JOIN x y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
p AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
m AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM x WHERE n > 0 AND p > q),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM (SELECT * FROM p UNION ALL SELECT * FROM m))
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 10"""

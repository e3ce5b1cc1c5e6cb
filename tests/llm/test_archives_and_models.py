"""Archives, shards, the classifier and the pipeline: round trips, exact counts, held-out accuracy, edge rows."""

import base64
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import mil_classifier, queries, sharding, warc

SF = "/root/testdata/sf0.001"

# --- WARC -----------------------------------------------------------------------


def _pages():
    rng = random.Random(4)
    body = lambda n: "".join(rng.choice("aé<\r\n") for _ in range(n))
    same = body(5000)
    pages = [(i, f"http://x/{i}", body(rng.choice([0, 1, 50, 3000]))) for i in range(40)]
    pages += [(100 + i, f"http://y/{i}", same) for i in range(20)] + [(99, "u", None), (98, None, ""), (97, "WARC/1.1", "WARC/1.1\r\n\r\n0\r\n\r\n")]
    return pages


@pytest.mark.parametrize("segment", [warc.SEGMENT_BYTES, 300])
def test_archives_give_back_every_page(spark, tmp_path, segment):
    pages = _pages()
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id bigint, url string, html string, name int")
    warc.write_archives(df.repartition(5), str(tmp_path / "w"), segment_bytes=segment, records_per_file=7)
    first, want = {}, {}
    for i, _, html in sorted(pages):
        data = (html or "").encode()
        at = first.setdefault(data, i)
        want[i] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if at == i else "revisit", None if at == i else at)
    rows = warc.read_pages(spark, str(tmp_path / "w")).collect()
    assert {r.page_id: tuple(r)[1:] for r in rows} == want and len(rows) == len(pages)
    texts = {bytes(r.payload) for r in warc.reassembled(warc.read_records(spark, str(tmp_path / "w"))).collect()}
    assert texts == set(first)


def test_repeated_rows_null_ids_and_empty_tables(spark, tmp_path):
    schema = "page_id bigint, url string, html string"
    df = spark.createDataFrame([(1, "u", "x" * 900), (1, "u", "x" * 900), (2, "u", "x" * 900), (None, "u", "x" * 900), (None, None, None)], schema)
    warc.write_archives(df, str(tmp_path / "a"), segment_bytes=200)
    rows = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in warc.read_pages(spark, str(tmp_path / "a")).collect()), key=repr)
    assert rows == sorted([(1, "response", None)] * 2 + [(2, "revisit", 1), (0, "revisit", 1), (0, "response", None)], key=repr)
    warc.write_archives(df.where("page_id > 5"), str(tmp_path / "b"))
    assert warc.read_pages(spark, str(tmp_path / "b")).count() == 0


def test_pages_of_one_payload_are_split(spark):
    """A third of all pages hold one payload: the join that names their response reads them in parts."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        html = F.when(F.col("id") % 3 == 0, F.lit("error")).otherwise(F.concat(F.lit("page "), "id"))
        pages = spark.range(9000, numPartitions=8).select(F.col("id").alias("page_id"), F.sha2(F.col("id").cast("string"), 256).alias("url"), html.alias("html"))
        named = warc.page_table(pages)
        assert len(named.collect()) == 9000
        assert "skew=true" in named._jdf.queryExecution().executedPlan().toString()
        assert named.where("of is not null").count() == 2999
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lost_or_cut_segments_fail(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc" * 900)], "page_id bigint, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"), segment_bytes=500)
    records = warc.read_records(spark, str(tmp_path / "a"))
    for bad in ("segment <> 2", "total is null"):
        with pytest.raises(Exception, match="segments are missing"):
            warc.reassembled(records.where(bad)).collect()
    short = records.withColumn("block", F.when(F.col("segment") == 2, F.expr("substring(block, 2)")).otherwise(F.col("block")))
    with pytest.raises(Exception, match="declared"):
        warc.reassembled(short).collect()


def test_chunked_framing():
    rng = random.Random(1)
    for n in (0, 1, 4096, 10_000):
        data = "".join(rng.choice("aé\r\n0") for _ in range(n)).encode()
        assert warc.dechunked(warc.chunked(data, 77)) == data
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"3\r\nabcd\r\n0\r\n\r\n")


# --- shards ----------------------------------------------------------------------


@pytest.mark.parametrize("region", [10**9, 150])
def test_matrix_sums_are_exact(region):
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 60, 40)
    room = sharding.split_evenly(int(counts.sum()), 24)
    matrix = sharding.communication_matrix(counts, room, 3, region)
    assert (matrix.sum(axis=1) == counts).all() and (matrix.sum(axis=0) == room).all() and (matrix >= 0).all()


def test_matrix_follows_the_hypergeometric_law():
    draws = np.array([sharding.communication_matrix(np.array([30, 70]), np.array([50, 50]), s)[0, 0] for s in range(3000)])
    assert abs(draws.mean() - 15) < 0.2 and abs(draws.var() - 30 * 0.25 * 70 / 99) < 0.5


def test_large_tables_follow_the_same_law():
    """Above the size that numpy draws, shares of blocks vary as they do below it."""
    counts, room = np.array([300, 300, 300, 300]), np.array([400, 400, 400])
    for region in (600, 100):
        first = np.array([sharding.communication_matrix(counts, room, s, region)[:2, 0].sum() for s in range(2000)])
        assert abs(first.mean() - 200) < 1
        assert 0.9 < first.var() / (600 * (1 / 3) * (2 / 3) * 600 / 1199) < 1.1
    big = sharding.communication_matrix(np.full(4, 10**9), np.full(4, 10**9), 1)
    assert (big.sum(axis=0) == 10**9).all() and (big.sum(axis=1) == 10**9).all() and len(set(big.ravel().tolist())) > 4


def test_shards_are_even_gapless_and_uniform(spark, documents):
    docs = documents(*[(i, f"t{i % 5}") for i in range(2000)], (None, None), (7, "t2"), (7, "t2"))
    out = sharding.shuffle_into_shards(docs, partitions=8, blocks=3).select("row.doc_id", "shard", "slot").collect()
    assert len(out) == 2003
    for shard in range(8):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (250, 251)
    place = {r.doc_id: r.slot for r in out if r.shard == 0}
    half = [i for i in place if i is not None and i < 1000]
    assert 85 < len(half) < 165  # neither half of the table prefers a shard
    again = sharding.shuffle_into_shards(docs.repartition(5), partitions=8, blocks=3).select("row.doc_id", "shard", "slot")
    assert {(r.doc_id, r.shard, r.slot) for r in again.collect()} == {(r.doc_id, r.shard, r.slot) for r in out}
    assert sharding.shuffle_into_shards(docs.where("doc_id < 0")).count() == 0


# --- classifier --------------------------------------------------------------------


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    x, bag, y = rng.normal(size=(9, 5)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    shapes = {"encode": (5, 4), "encode_0": (4,), "attend": (4, 3), "gate": (4, 3), "weigh": (3,), "out": (4,), "out_0": ()}
    w = {k: rng.normal(size=s) for k, s in shapes.items()}

    def loss(w):
        p = mil_classifier._forward(w, x, bag)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for k, grad in mil_classifier._gradients(w, x, bag, y).items():
        for at in np.ndindex(shapes[k]):
            moved = {n: v.copy() for n, v in w.items()}
            moved[k][at] += 1e-6
            assert (loss(moved) - loss(w)) / 1e-6 == pytest.approx(grad[at], abs=1e-4)


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(400):
        bag = rng.normal(0, 0.1, (rng.integers(2, 9), 6))
        bag[:, 0] = 0
        if i % 2:
            bag[rng.integers(0, len(bag)), 0] = 1
        bags.append(bag)
        labels.append(float(i % 2 == 0))
    ends = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    model = mil_classifier.train(np.concatenate(bags), ends, np.array(labels))
    scores, attention = model.attend(np.concatenate(bags).astype(np.float32), ends)
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.97
    hits = [np.argmax(attention[a:b]) == np.argmax(x[:, 0]) for a, b, x, y in zip(ends[:-1], ends[1:], bags, labels, strict=True) if not y]
    assert np.mean(hits) > 0.9


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op1_attention_mil"](spark, SF.replace("0.001", "0.01")).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and np.mean([a == b for a, b in judged]) > 0.93


def test_classifier_edges(spark, documents):
    docs = documents((1, None), (2, ""), (3, "x " * 5000), (3, "x " * 5000), (None, "y"))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = mil_classifier.score(docs, mil_classifier.fit(docs, none)).collect()
    assert len(rows) == 5 and all(r.score == 0.5 for r in rows)
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    rows = mil_classifier.score(docs, mil_classifier.fit(docs, labels)).collect()
    assert all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if r.doc_id == 3}) == 1
    assert mil_classifier.score(docs.where("doc_id < 0"), mil_classifier.fit(docs, none)).count() == 0


# --- pipeline and queries ---------------------------------------------------------------


def test_stages_keep_the_documents_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name in ("quality_rules", "ngram_join"):
            assert docs.count() < before
            before = docs.count()
        if name == "pii":
            assert docs.where("text rlike '[a-z]@mail[0-9]'").isEmpty() and not docs.where("text like '%<EMAIL>%'").isEmpty()
        if name != "packing":
            assert docs.columns == columns
    assert docs.agg(F.sum("length")).first()[0] > 0


def test_an_empty_table_passes_all_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.schema(spark.read.parquet(str(tmp_path / name)).schema).parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_the_pipeline_runs_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_tasks_follow_the_rows():
    assert [sharding.task_count(n) for n in (0, 10**6, 128 * 10**6, 128 * 10**6 + 1, 10**9, 10**12)] == [128, 128, 128, 129, 1000, 2048]


def test_long_bags_are_thinned_evenly():
    assert mil_classifier._spaced(5, 9).tolist() == [5, 6, 7, 8]
    picked = mil_classifier._spaced(10, 100_010)
    assert len(set(picked.tolist())) == mil_classifier.FIT_PASSAGES and picked[0] == 10 and picked[-1] == 100_009


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert got.columns == columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())

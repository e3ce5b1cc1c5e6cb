import random
import re
from collections import Counter

import pytest

from pyspark.sql import functions as F

from ledgerloom.operators import textindex, textmatch
from ledgerloom.session import set_for
from tests.conftest import plan_of

RECORDS = [
    "What is it? a) this b) that|a",
    "No options here|b",
    "Two marks? x ? y|c",
    "doubled?? opts|d",
    "no answer mark",
    "too|many|marks",
    "",
    "ends with mark?|e",
    "|only answer",
]


def naive_split(records):
    good, bad = [], []
    for r in records:
        parts = r.split("|")
        if len(parts) != 2:
            bad.append(r)
            continue
        pieces = re.split(r"[?]+", parts[0])
        question, options = pieces if len(pieces) == 2 else (parts[0], "")
        good.append((question, options, parts[1]))
    return good, bad


def test_records_split_like_the_plain_loop(spark, rows):
    df = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    good, bad = naive_split(RECORDS)
    assert rows(textmatch.split_questions(df), "questions", "options", "answers") == sorted(good, key=repr)
    assert rows(textmatch.quarantined_records(df)) == sorted([(b,) for b in bad], key=repr)


def test_cut_records_keeps_positions(spark, rows):
    df = spark.createDataFrame([(1, "a;b;;c"), (2, "")], "id int, t string")
    assert rows(textmatch.cut_records(df, "t", ";", "id")) == [
        (1, 0, "a"), (1, 1, "b"), (1, 2, ""), (1, 3, "c"), (2, 0, ""),
    ]


def test_dedupe_keeps_the_first_copy(spark, rows):
    df = spark.createDataFrame(
        [(2, 1, "Same? "), (1, 5, "\nSAME?"), (1, 9, "same?"), (3, 1, "other"), (4, 1, None), (5, 1, None)],
        "file int, pos int, q string",
    )
    assert rows(textmatch.dedupe_by_text(df, "q", "file", "pos")) == [
        (1, 5, "same?"), (3, 1, "other"), (4, 1, None),
    ]


def test_closest_each_equals_one_by_one(spark, rows):
    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate("alpha beta gamma delta alphabet gamut".split())], "n int, t string"
    )
    questions = ["alpha", "gam"]
    each = textmatch.closest_each(df, "t", questions, 2, ["n"])
    want = [
        (q, place + 1, r["n"], r["score"])
        for q in questions
        for place, r in enumerate(textmatch.closest(df, "t", q, 2, ["n"]).collect())
    ]
    assert rows(each, "question", "place", "n", "score") == sorted(want, key=repr)


def _indexed(spark, path, texts, **settings):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    textindex.store_gram_index(df, "t", str(path), **settings)
    return df, textindex.GramIndex(spark, str(path), "t", **settings)


def _near_texts():
    rng = random.Random(8)
    base = ["the quick brown fox jumps over it", "a slow green turtle sleeps below", "\U0001f600 smile \U0001f600\U0001f601 wide"]
    out = [None, "", "a", "ab", "abc", "x" * 3000, None]
    for i in range(150):
        t = list(rng.choice(base)) if i % 3 else [rng.choice("abc \U0001f600") for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(0, len(t))
            t[at : at + rng.randint(0, 1)] = rng.choice(["", "z", "\U0001f602", "qu"])
        out.append("".join(t))
    return out


@pytest.mark.parametrize("top", [1, 4, 400])
def test_indexed_lookup_equals_scoring_every_row(spark, rows, tmp_path, top):
    df, index = _indexed(spark, tmp_path / "i", _near_texts(), buckets=7)
    questions = ["the quick brown fox jumps over it", "green turtle", "\U0001f600 smile", "", "zz"]
    columns = ["n", "t", "question", "score", "place"]
    assert rows(index.closest_each(questions, top, ["n"]), *columns) == rows(textmatch.closest_each(df, "t", questions, top, ["n"]), *columns)
    for q in questions:
        got = [tuple(r) for r in index.closest(q, top, ["n"]).select("n", "t", "score").collect()]
        assert got == [tuple(r) for r in textmatch.closest(df, "t", q, top, ["n"]).select("n", "t", "score").collect()]


def test_bounds_are_never_below_the_score(spark, tmp_path):
    _, index = _indexed(spark, tmp_path / "i", _near_texts(), q=2)
    for question in ("a slow green turtle", "\U0001f600\U0001f601", ""):
        scored = index._scored(index.bounds([question]), [question])
        assert scored.where("score > bound or (score is null) <> (bound is null)").count() == 0


def test_few_rows_are_scored(spark, tmp_path):
    texts = [f"{'filler' * (i % 40)} {i}" for i in range(2000)] + ["which account was closed last month"] * 3
    _, index = _indexed(spark, tmp_path / "i", texts)
    effort = index.effort(["which account was closed last month?", "nothing like it 17"], 3).collect()
    assert {r.question: (r.rows, r.scored) for r in effort}["which account was closed last month?"] == (2003, 3)
    assert all(r.scored < r.rows for r in effort)


def test_a_lookup_opens_only_its_buckets(spark, tmp_path):
    _, index = _indexed(spark, tmp_path / "i", ["alpha beta", "gamma delta"] * 20, buckets=32)
    assert "bucket" in plan_of(index.shared(["abcd"])).split("PartitionFilters")[1].split("]")[0]
    assert index.shared(["no"]).count() == 0
    assert {r.b for r in index.grams.select(F.col("bucket").alias("b")).distinct().collect()} <= set(range(32))


def test_lookup_in_an_empty_index(spark, tmp_path):
    df = spark.createDataFrame([], "n int, t string")
    textindex.store_gram_index(df, "t", str(tmp_path / "i"))
    index = textindex.GramIndex(spark, str(tmp_path / "i"), "t")
    assert index.closest("question", 3).count() == 0
    assert [tuple(r) for r in index.effort(["question"]).collect()] == [("question", 0, 0)]


def test_runs_are_counted_inside_each_row(spark, rows):
    texts = [*_near_texts(), "aaaa\U0001f600aaaa", "abcabcab", "\n\n\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    counted = df.select("n", F.inline(textindex.counted_grams(F.col("t")))).toDF("row", "gram", "times")
    assert not re.search("Aggregate|Exchange|Sort", plan_of(counted))
    want = Counter(tuple(r) for r in df.select("n", F.explode(textindex.grams(F.col("t")))).collect())
    assert rows(counted) == sorted(((*key, n) for key, n in want.items()), key=repr)


def test_a_task_writes_a_bounded_part_of_the_index(spark, tmp_path, monkeypatch):
    """Runs of one directory are written by as many tasks as their bytes ask for."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    monkeypatch.setattr(textindex, "WRITE_BYTES", 4096)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(100, 900))) for _ in range(400)]
    with set_for(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        df, index = _indexed(spark, tmp_path / "i", texts, buckets=1)
    assert len(list((tmp_path / "i" / "grams" / "bucket=0").glob("*.parquet"))) > 1
    assert index.grams.agg(F.sum("n")).first()[0] == sum(len(t) - 2 for t in texts)
    assert spark.conf.get(name) == before

"""Quality rules, mixing, fingerprints: results against plain Python, edge rows, no Python in the plans."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, quality_rules, syncmers, text
from tests.conftest import plan_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b\x0bc d"), (6, "a a a a a a"), (7, "a b c x a b c\nq\nq\n\nq"), (None, "null id")]


def native(df):
    return not re.search("EvalPython|InArrow|InPandas|PythonUDF", plan_of(df))


def _stats(t):
    t = t or ""
    w = WORD.findall(t)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(tri)
    marked = {i + k for i, x in enumerate(tri) if seen[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))


def _random_texts(n=60):
    rng = random.Random(6)
    out = []
    for i in range(n):
        words = [rng.choice(["a", "bb", "ccc", "é", "#x", "d" * (1 + i % 4)]) + str(rng.randint(0, 1 + i * i)) for _ in range(rng.randint(0, 200))]
        out.append((100 + i, "".join(w + rng.choice([" ", "\n", "\t ", "  "]) for w in words)))
    out.append((500, " ".join(f"w{i % 700}" for i in range(6000))))
    out.append((501, "x" * 50_000))
    return out


def test_features_equal_plain_python(spark, documents):
    pairs = EDGE + _random_texts()
    got = {r["row"]["doc_id"]: tuple(r[f] for f in quality_rules.BASE_FEATURES) for r in quality_rules.judged(documents(*pairs)).collect()}
    assert got == {i: _stats(t) for i, t in pairs}


def test_order_of_rules_never_changes_the_verdict(spark, documents):
    docs = documents(*EDGE, *_random_texts(), (900, "GOOD NIGHT " * 60), (901, "fine prose without fault " + " ".join(f"word{i}" for i in range(80))))
    verdict = lambda rules: {r["row"]["doc_id"] for r in quality_rules.cascade(docs, rules).where("rejected_by is null").collect()}
    forward, backward = verdict(quality_rules.RULES), verdict(quality_rules.RULES[::-1])
    assert forward == backward and 901 in forward and 900 not in forward and 1 not in forward
    kept = quality_rules.passing(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == forward
    assert native(kept)


def test_only_base_features_are_worked_out_ahead(spark, documents):
    docs = documents(*EDGE, *_random_texts(), (900, "GOOD NIGHT " * 60), (902, " ".join(f"Word{i} #" for i in range(80))))
    judged = quality_rules.judged(docs)
    assert judged.columns == ["row", *quality_rules.BASE_FEATURES, "rejected_by"]
    kept = lambda df: {r["row"]["doc_id"] for r in df.where("rejected_by is null").collect()}
    assert kept(judged) == kept(quality_rules.cascade(docs))
    # Lines and capitals are counted inside the verdict, never as columns.
    plan = plan_of(judged)
    assert "\\p{Lu}" in plan and "AS n_words" in plan and "AS n_upper" not in plan and "AS n_lines" not in plan


def test_copies_equal_a_running_sum(spark, documents):
    """Expected copies added up along each source in plain Python, one copy per whole number crossed."""
    rng = random.Random(12)
    pairs = [(i, " ".join("w" * rng.choice([0, 1, 2, 30, 400]) for _ in range(rng.choice([1, 5, 300])))) for i in range(400)]
    docs = documents(*pairs, sources={i: rng.choice(["a", "a", "a", "b", "é", None]) for i, _ in pairs})
    seed, splits = mixing.SEED, mixing.SPLITS
    marks = docs.select(
        "doc_id",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(splits)).alias("split"),
        F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), F.lit(1 << 20)).alias("offset"),
    )
    drawn = {r.doc_id: (r.split, r.offset / (1 << 20)) for r in marks.collect()}
    by_source = {}
    for r in mixing.mix(docs).collect():
        by_source.setdefault(r["row"]["source"], []).append(r)
    for rows in by_source.values():
        step = rows[0].target / rows[0].source_size
        rows.sort(key=lambda r: (math.floor(math.log2(r.size + 1) * 8), drawn[r["row"]["doc_id"]][0], r.size, r["row"]["doc_id"]))
        offset = drawn[rows[0]["row"]["doc_id"]][1]
        assert len({drawn[r["row"]["doc_id"]][1] for r in rows}) == 1
        crossed = [math.floor(step * k + offset) - math.floor(step * (k - 1) + offset) for k in range(1, len(rows) + 1)]
        assert [r.copies for r in rows] == [min(c, math.ceil(step)) for c in crossed]


def test_rules_come_by_rejections_per_cost(spark, documents):
    never = quality_rules.Rule("never", lambda f: f("n_repeat_words") < 0)
    always = quality_rules.Rule("always", lambda f: f("n_words") >= 0)
    docs = documents(*_random_texts())
    assert [r.name for r in quality_rules.order_rules(docs, [never, always])] == ["always", "never"]


@pytest.mark.parametrize("operator", [quality_rules.passing, mixing.mixed_documents, syncmers.edited_fingerprints])
def test_empty_tables(documents, spark, operator):
    empty = documents((1, "x")).where("doc_id < 0")
    assert operator(empty).count() == 0


def _targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, total = dict.fromkeys(names, 0.0), sum(sizes.values())
    free = set(names)
    while free:
        rest = total - sum(target[s] for s in names if s not in free)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            target.update(share)
            break
        for s in above:
            target[s] = 3.0 * sizes[s]
        free -= above
    return target


def test_targets_equal_repeated_resharing(spark):
    rng = random.Random(7)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 1000, 90_000]) for i in range(rng.randint(1, 9))} | {None: 17, "é": 3}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(_targets(sizes))


def test_mix_meets_targets_and_never_exceeds_three_copies(spark, documents):
    rng = random.Random(1)
    source = {i: rng.choice(["hot", "hot", "hot", "a", None]) for i in range(3000)} | {5000: "tiny", 5001: "é"}
    docs = documents(*[(i, " ".join(["w"] * rng.randint(0, 40))) for i in range(3000)], (5000, "one two"), (5001, None), (5001, None), sources=source)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and max(r.copies for r in rows) <= 3
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        s = r["row"]["source"]
        taken[s] += r.copies * r.size
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= 8 * largest[s] + 1
    again = {(r["row"]["doc_id"], r.copies) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r["row"]["doc_id"], r.copies) for r in rows}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert native(mixed)


def _plain_anchors(words, k, s, hashed):
    inner = [hashed[tuple(words[i : i + s])] for i in range(len(words) - s + 1)]
    span = k - s + 1
    runs = [inner[i : i + span] for i in range(len(inner) - span + 1)]
    return [r for r in runs if min(r) in (r[0], r[-1])]


def test_anchors_are_closed_syncmers(spark):
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 60)}" for _ in range(400)]
    pairs = sorted({tuple(words[i : i + 2]) for i in range(399)})
    df = spark.createDataFrame(pairs, "a string, b string")
    hashed = {(r.a, r.b): r.h for r in df.select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    want = _plain_anchors(words, 8, 2, hashed)
    frame = spark.createDataFrame([(r,) for r in want], "r array<bigint>").select(F.hash("r").alias("h"))
    text_frame = spark.createDataFrame([(" ".join(words),)], "t string")
    got = text_frame.select(syncmers.anchors(F.col("t"))).first()[0]
    assert got == [r.h for r in frame.collect()] and 60 < len(got) < 160


def test_every_text_with_words_has_an_anchor(spark):
    """Texts of 8 to 12 words may have no closed run; their smallest hash stands in, and unrelated ones are not alike."""
    rng = random.Random(4)
    texts = [[f"w{rng.randint(0, 10**6)}" for _ in range(n)] for n in range(8, 14) for _ in range(40)]
    pairs = sorted({tuple(t[i : i + 2]) for t in texts for i in range(len(t) - 1)})
    hashed = {(r.a, r.b): r.h for r in spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    all_runs = [[[hashed[p] for p in zip(t[i : i + 7], t[i + 1 : i + 8], strict=True)] for i in range(len(t) - 7)] for t in texts]
    frame = spark.createDataFrame([(r,) for runs in all_runs for r in runs], "r array<bigint>").select("r", F.hash("r").alias("h"))
    hash_of = {tuple(r.r): r.h for r in frame.collect()}
    want = [[hash_of[tuple(r)] for r in _plain_anchors(t, 8, 2, hashed)] or [min(hash_of[tuple(r)] for r in runs)] for t, runs in zip(texts, all_runs, strict=True)]
    a = syncmers.anchors(F.col("a"))
    df = spark.createDataFrame([(" ".join(t), " ".join(o)) for t, o in zip(texts, texts[1:] + texts[:1], strict=True)], "a string, b string")
    rows = df.select(a, syncmers.likeness(a, syncmers.anchors(F.col("b"))), syncmers.likeness(a, syncmers.anchors(F.lit(" "))), syncmers.likeness(a, a)).collect()
    assert [r[0] for r in rows] == want
    assert sum(not _plain_anchors(t, 8, 2, hashed) for t in texts) > 40
    assert all(tuple(r[1:]) == (0.0, 0.0, 1.0) for r in rows)
    blank = spark.createDataFrame([("", " \n")], "a string, b string").select(syncmers.likeness(a, syncmers.anchors(F.col("b"))))
    assert blank.first()[0] == 1.0


def test_edits_move_no_anchor_outside_their_reach(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(300)]
    edited = [*words[:150], "new", "words", "here", *words[150:]]
    df = spark.createDataFrame([(" ".join(words), " ".join(edited))], "a string, b string")
    a, b = df.select(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).first()
    assert len(set(a) - set(b)) <= 8
    assert df.select(syncmers.likeness(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b")))).first()[0] > 0.8


def test_edited_texts_follow_the_next_document(spark, documents):
    pairs = [(i, t) for i, t in EDGE if i is not None] + [(i, f"é{i} " * (i % 37)) for i in range(20, 400)]
    docs = documents(*pairs)
    order = sorted(pairs, reverse=True)
    want = {}
    for at, (i, t) in enumerate(order):
        t, follower = t or "", order[(at + 1) % len(order)][1] or ""
        half = len(t) // 2
        want[i] = (len(t), hashlib.sha256((t[: len(t) - half] + follower[:half]).encode()).hexdigest())
    rows = syncmers.edited_fingerprints(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == want
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] == prints[3] == "" and len(prints[4]) == 8
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert native(syncmers.edited_fingerprints(docs)) and "SinglePartition" not in plan_of(syncmers.edited_fingerprints(docs))


def test_single_document_follows_itself_and_repeated_rows_stay(spark, documents):
    (row,) = syncmers.edited_fingerprints(documents((1, "abcd"))).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert syncmers.edited_fingerprints(documents((1, "a b"), (1, "a b"), (None, "c"))).count() == 3


def test_words(spark):
    df = spark.createDataFrame([(t,) for _, t in EDGE], "t string")
    assert [r[0] for r in df.select(text.words(F.col("t"))).collect()] == [WORD.findall(t or "") for _, t in EDGE]

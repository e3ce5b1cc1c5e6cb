"""Vector codes, token files and the source audit: results against plain Python, round trips, edge rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import divergence, token_files, vector_codes
from ledgerloom.llm.tokens import WordTokenizer, default_tokenizer
from tests.conftest import plan_of

# --- vector codes ------------------------------------------------------------------------


def _plain_codes(rows, parts=8, entries=16, rounds=6, size=2):
    """Product codes by trying every entry, in Python numbers."""
    kept = [(i, [int(np.floor(4096 * np.float64(x))) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = sorted([(i, v + [0] * (parts * size - len(v)), l) for i, v, l in kept], key=lambda r: (r[0] is None, r[0], r[1]))
    cut = [[v[j * size : (j + 1) * size] for j in range(parts)] for _, v, _ in kept]
    books = [[c[j] for c in cut[:entries]] for j in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    pick = lambda part, book: min((square(part, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for j in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[pick(c[j], books[j])[1]].append(c[j])
            for k, members in own.items():
                books[j][k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(r[0], [pick(c[j], books[j]) for j in range(parts)], r[2]) for r, c in zip(kept, cut, strict=True)]
    by_label = Counter()
    for _, codes, label in found:
        by_label[label] += sum(d for d, _ in codes)
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in codes), sum(d for d, _ in codes), by_label[l], sha) for i, codes, l in found),
        key=repr,
    )


def _vectors(spark, rows):
    rows = [(i, v, l, "x", 0, i) for i, v, l in rows]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, code string, _n int, _label bigint")


def _random_vectors(n, size=16):
    rng = random.Random(n)
    return [(rng.randrange(10 * n), [float(np.float32(rng.choice([rng.gauss(0, 1), 0.0, 0.5]))) for _ in range(size)], rng.choice([1, 1, 1, 2, None])) for _ in range(n)]


def test_codes_equal_trying_every_entry(spark, rows):
    given = _random_vectors(150)
    given += [(3, None, 1), (4, [1.0] * 15 + [None], 1), (5, [float("nan")] * 16, 2), (6, [float("-inf")] * 16, 2)]
    given += [(7, [0.25] * 16, 3)] * 3 + [(None, [0.5] * 16, None), (-2, [1.0, -1.0], 9), (-1, [], 9)]
    got = vector_codes.compressed(_vectors(spark, given))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows(got) == _plain_codes(given)


def test_codes_of_few_and_no_vectors(spark, rows):
    few = _random_vectors(5, size=24)
    assert rows(vector_codes.compressed(_vectors(spark, few))) == _plain_codes(few, size=3)
    none = _vectors(spark, [(1, None, 1), (2, [float("nan")], None)])
    assert vector_codes.compressed(none).count() == 0
    assert vector_codes.compressed(none.where("vec_id < 0")).count() == 0


def test_codes_of_very_large_components(spark, rows):
    given = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(0, 1e5, 8)], 1) for i in range(20)]
    assert rows(vector_codes.compressed(_vectors(spark, given))) == _plain_codes(given, size=1)
    huge = vector_codes.compressed(_vectors(spark, [*given, (99, [3e38] * 8, 1)])).where("vec_id = 99").first()
    assert 0 <= huge.error <= vector_codes.MOST_LONG and huge.label_error <= vector_codes.MOST_LONG


@pytest.mark.parametrize("size", [1, 2, 3, 8, 13])
def test_nearest_entry_with_ties(size):
    rng = np.random.default_rng(size)
    parts, entries = rng.integers(-3, 4, (400, size)), rng.integers(-3, 4, (16, size))
    entries[9] = entries[2]
    index, distance = vector_codes.nearest(parts, entries)
    every = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert index.tolist() == every.argmin(1).tolist() and distance.tolist() == every.min(1).tolist()


def test_transform_is_in_sequency_order_and_keeps_scaled_distances():
    for width in (1, 2, 8, 16):
        rows = vector_codes.transformed(np.eye(width, dtype=np.int64)).T
        assert np.array_equal(rows @ rows.T, width * np.eye(width))
        assert (rows[:, 1:] != rows[:, :-1]).sum(1).tolist() == list(range(width))


def test_hot_and_rare_labels_get_their_sums(spark):
    codes = spark.range(5000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("label"), F.lit("00").alias("code"), F.lit(2).cast("bigint").alias("error"))
    got = {(r.label is None, r.label_error): r["count"] for r in vector_codes.with_label_errors(codes).groupBy("label", "label_error").count().groupBy("label", "label_error").agg(F.sum("count").alias("count")).collect()}
    assert got[(True, 2 * 1667)] == 1667 and got[(False, 2)] == 1


# --- token files -------------------------------------------------------------------------


@pytest.mark.parametrize("most", [1, 2, 300, 50_000, 1 << 31])
def test_blocks_give_back_their_ids(most):
    rng = np.random.default_rng(most)
    for n in (1, 5, 1023, 1024, 1025, 5000):
        ids = np.where(rng.random(n) < 0.9, rng.integers(0, max(1, most // 100), n), rng.integers(0, most, n)).astype(np.uint32)
        data, starts, first = token_files.encode_blocks(ids)
        assert first.tolist() == list(range(0, n, 1024)) and len(starts) == len(first)
        assert np.array_equal(token_files.decode_blocks(np.frombuffer(data, np.uint8), starts), ids)
    if most == 50_000:
        assert len(data) < 4 * n


def test_outliers_do_not_widen_a_block():
    ids = np.full(1024, 7, np.uint32)
    ids[5] = 40_000
    assert len(token_files.encode_blocks(ids)[0]) == token_files.BLOCK_HEAD.itemsize + 6


def _files_of(spark, path):
    return sorted((token_files.TokenFile(bytes(r.content)) for r in token_files._files(spark, path).collect()), key=lambda f: f.key)


def test_documents_come_back_in_order(spark, documents, tmp_path, monkeypatch):
    rng = random.Random(3)
    pairs = [(rng.randrange(-500, 500), "".join(rng.choice(["the ", "Zürich ", "a1b2,", "#\n", "深い ", "<|endoftext|> ", "\x00 "]) for _ in range(rng.choice([0, 1, 40, 900])))) for _ in range(120)]
    pairs += [(None, "null id"), (None, None), (7, ""), (8, None), (9, "same"), (9, "same"), (9, "other"), (10, "long words " * 60_000)]
    path = str(tmp_path / "tokens")
    token_files.write_token_files(documents(*pairs), path, task_bytes=50_000)
    got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert len(got) == len(pairs)
    words = WordTokenizer(default_tokenizer())
    want = Counter((i, np.append(words([t or ""])[0], 2).astype("<u4").tobytes()) for i, t in pairs)
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    ids = [r.doc_id for r in got]
    assert ids == sorted((i for i in ids if i is not None)) + [None, None]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)
    files = _files_of(spark, path)
    assert len(files) > 3
    every = np.concatenate([f.ids(0, f.size) for f in files])
    assert zlib.crc32(every.astype("<u4").tobytes()) == zlib.crc32(b"".join(bytes(r.ids) for r in got))
    longest = max(files, key=lambda f: f.size)
    whole = longest.ids(0, longest.size)
    for a, b in ((0, 1), (1000, 1030), (longest.size - 3, longest.size), (5, 5), (1024, 4096)):
        assert np.array_equal(longest.ids(a, b), whole[a:b])


def test_long_tasks_write_several_files(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "RUNS", 1)
    pairs = [(i, f"text {i} " * 700_000) for i in range(4)]
    path = str(tmp_path / "tokens")
    token_files.write_token_files(documents(*pairs), path, task_bytes=1 << 40)
    assert [f.key for f in _files_of(spark, path)] == [(0, k) for k in range(len(_files_of(spark, path)))]
    got = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [0, 1, 2, 3] and got[3].start == sum(r.n_tokens for r in got[:3])


def test_an_empty_table_has_no_files(spark, documents, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(documents((1, "x")).where("doc_id < 0"), path)
    assert token_files.read_documents(spark, path).count() == 0


def test_a_foreign_file_is_refused():
    with pytest.raises(ValueError, match="not a token file"):
        token_files.TokenFile(b"x" * 100)


# --- source divergence -------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _plain_audit(docs, least=10, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [((l or ""), (s or ""), [x.translate(lower) for x in TERM.findall(t or "")]) for l, s, t in docs]
    out = []
    for lang in {l for l, _, _ in docs}:
        own = [(s, t) for l, s, t in docs if l == lang]
        frequency = Counter(x for _, t in own for x in set(t))
        kept = {x for x, n in frequency.items() if n >= least}
        count = defaultdict(Counter)
        for s, t in own:
            count[s].update(x for x in t if x in kept)
        everything = sum(count.values(), Counter())
        share = lambda c: {x: 1 + 10**9 * (c[x] + 2) // (sum(c.values()) + 2 * len(kept)) for x in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(everything)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = [(o, sum(f(p[s][x], p[o][x]) for x in kept)) for o in count if o != s]
            terms = [(x, f(p[s][x], q[x])) for x in kept if count[s][x] and p[s][x] > q[x]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, x, v, r) for r, (x, v) in enumerate(items[:most], 1)]
    return sorted(out, key=repr)


def _sourced(spark, docs):
    rows = [(i, t, l, s, 0, "x", 1) for i, (l, s, t) in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n bigint, term string, bucket int")


def _random_docs(n):
    rng = random.Random(n)
    vocabulary = [rng.choice(["w", "É", "深", "Ab"]) + "xyz"[i % 3] * (i // 3) for i in range(60)]
    docs = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "c", "Z", "é", None, ""])
        size = rng.choice([0, 3, 30, 200])
        text = "".join(rng.choice(vocabulary[: 20 + 10 * len(source or "")]) + rng.choice([" ", "1", "\n", "--", "\x00"]) for _ in range(size))
        docs.append((lang, source, text))
    return docs


@pytest.mark.parametrize("bucket_terms", [5, 1 << 15])
def test_audit_equals_plain_python(spark, rows, bucket_terms):
    docs = _random_docs(160) + [("fr", "only", "un deux"), ("it", "a", None), ("it", "b", ""), ("it", "b", "12 3"), ("xx", "a", "same " * 3), *[("pl", s, "Ten ten TEN") for s in "ab" * 8]]
    got = divergence.audit(_sourced(spark, docs), bucket_terms=bucket_terms)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(got) == _plain_audit(docs)
    assert not re.search("EvalPython|InArrow|InPandas|PythonUDF", plan_of(got))


def test_audit_of_an_empty_table_and_of_one_long_text(spark, rows):
    docs = _sourced(spark, [("en", "a", "x"), ("en", "b", "long term " * 100_000)])
    assert divergence.audit(docs.where("doc_id < 0")).count() == 0
    assert rows(divergence.audit(docs, least=1)) == _plain_audit([("en", "a", "x"), ("en", "b", "long term " * 100_000)], least=1)


def test_galloping_finds_the_first_place(spark):
    rng = random.Random(4)
    ids = sorted(rng.sample(range(3000), 700))
    asked = [(s, rng.randrange(-5, 3010)) for s in [0, 0, 0, *[rng.randrange(700) for _ in range(200)], 699, 700]]
    df = spark.createDataFrame(asked, "start int, wanted bigint").withColumn("ids", F.lit(ids).cast("array<bigint>"))
    for r in df.withColumn("found", divergence.first_at_least(F.col("ids"), F.col("start"), F.col("wanted"))).collect():
        assert r.found == next((k for k in range(r.start, 700) if ids[k] >= r.wanted), max(r.start, 700))

"""Duplicates, personal data, packing: results against brute force and exact round trips, edge rows."""

import random
import re
import time
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import ngram_join, packing, pii, suffix_dedup
from ledgerloom.llm.tokens import WordTokenizer, default_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "ONE\ttwo"), (6, "one two"), (None, "null id text here now")]


# --- n-gram join ------------------------------------------------------------------


def _near_corpus(seed=0):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    base, shared = fresh(300), fresh(60)
    docs = list(EDGE)
    for i in range(60):  # near copies of one text, each edited in its own places
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(300)] = f"e{rng.randint(0, 10**6)}"
        docs.append((100 + i, " ".join(words)))
    docs += [(200 + i, " ".join(fresh(rng.randint(5, 40)) + shared)) for i in range(40)]  # one passage in unlike texts
    docs += [(300 + i, " ".join(fresh(rng.randint(1, 80)))) for i in range(40)]
    docs += [(400, docs[20][1].upper()), (401, docs[20][1]), (402, " ".join(base + base))]
    chain = fresh(100)
    docs += [(500 + i, " ".join(chain[i * 8 :] + fresh(i * 8))) for i in range(5)]
    return docs


def _components(docs, n=5, percent=80):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(lower))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in sets if sets[i] and i is not None]
    for x, a in enumerate(ids):
        for b in ids[:x]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("seed", [0, 1])
def test_groups_equal_brute_force(spark, documents, seed):
    corpus = _near_corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicate_groups(documents(*corpus)).collect()}
    want = _components(corpus)
    assert got == want and len({c for _, c in want.values()}) < len(want) - 40


def test_one_document_of_each_group_stays(spark, documents):
    corpus = _near_corpus()
    docs = documents(*corpus)
    kept = ngram_join.first_of_each_group(docs)
    want = {i for i, (_, c) in _components(corpus).items() if i == c or i is None}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want
    assert ngram_join.near_duplicate_groups(docs.where("doc_id < 0")).count() == 0
    twice = documents((1, "a b c d e f"), (1, "a b c d e f"))
    assert ngram_join.near_duplicate_groups(twice).count() == 2 and ngram_join.first_of_each_group(twice).count() == 1


# --- suffix sorting -----------------------------------------------------------------


def _common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_deep_shallow_sort_equals_plain_sorting():
    rng = random.Random(2)
    for _ in range(60):
        stem = bytes(rng.choice(b"ab\0") for _ in range(60))
        strings = [stem[: rng.randint(0, 60)] + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 50))]
        order, shared = suffix_dedup.deep_shallow_sort(strings)
        ordered = [strings[i] for i in order]
        assert sorted(order.tolist()) == list(range(len(strings))) and ordered == sorted(strings)
        assert shared.tolist()[1:] == [_common(a, b) for a, b in zip(ordered, ordered[1:], strict=False)]


def _without_repeats(docs, length=100):
    seen, out = set(), {}
    for i, t in sorted(docs):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        out[i] = (len(data), bytes(x for x, g in zip(data, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("piece", [suffix_dedup.PIECE, 1 << 10])
def test_removed_bytes_equal_brute_force(spark, documents, monkeypatch, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(15, 60))) for _ in range(6)]
    docs = [(1, None), (2, ""), (3, "short"), (4, "ab" * 400), (5, "ab" * 300 + "c" + "ab" * 90), (6, "x" * 99), (7, "x" * 100), (8, "x" * 101)]
    for i in range(60):
        parts = [rng.choice(passages)[rng.randint(0, 40) :] if rng.random() < 0.5 else " ".join(word() for _ in range(20)) for _ in range(rng.randint(1, 6))]
        docs.append((10 + i, " ".join(parts)))
    docs += [(100 + i, docs[12][1]) for i in range(5)] + [(200, docs[13][1] * 30)]
    rows = suffix_dedup.without_repeats(documents(*docs)).collect()
    assert {r.doc_id: (r.n_bytes, bytes(r.kept)) for r in rows} == _without_repeats(docs)
    assert all(r.n_bytes - len(r.kept) == sum(b - a for a, b in r.spans) for r in rows)


def test_suffix_dedup_edges(spark, documents):
    assert suffix_dedup.without_repeats(documents((1, "x")).where("doc_id < 0")).count() == 0
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(80))
    rows = suffix_dedup.without_repeats(documents((None, text), (2, text), (2, text))).collect()
    assert sorted(len(r.kept) for r in rows) == [0, 0, len(text)]


# --- personal data --------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(t)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), m.end(), 2) for m in CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    pieces = ["a", "b.", "@", ".", "-", "x1", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "007.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+", " ", "a@b.c", "a@b.c_d@e.f", "é", "٣", "\n", "12345678901234567890"]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(t) == _plain_spans(t), t
    long = "a" * 200_000 + "1" * 200_000 + "@" * 1000
    assert pii.base_spans(long) == []


@pytest.fixture(scope="module")
def weights(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    return pii.fit(empty)


def test_the_random_field_adds_what_patterns_miss(weights):
    text = "Write to jo at mailhost dot org or call (212) 555-0143, card 4111.1111.1111.1111. Then +1 (826) 555-4081 190.137.223.4 end"
    base, added = pii.find(text, weights)
    found = {(pii.KINDS[k], text[a:b]) for a, b, k in added}
    assert {("email", "jo at mailhost dot org"), ("phone", "+1 (826) 555-4081")} <= found
    assert ("ip", "190.137.223.4") in {(pii.KINDS[k], text[a:b]) for a, b, k in base}
    assert not any(x < b and a < y for a, b, _ in added for x, y, _ in base)


def test_every_spelled_form_is_found_alone(weights):
    """Each writing of the at-sign with each writing of the dot, with no other mark in the text."""
    for at in (" at ", "(at)", " (at) ", "[at]", " [at] ", "@", " @ ", " AT "):
        for dot in (" dot ", "(dot)", " (dot) ", "[dot]", " [dot] ", ".", " DOT "):
            address = f"jo{at}mailhost{dot}org"
            text = f"please write to {address} today"
            start = text.index(address)
            found = list(pii.windows(text, []))
            assert len(found) == 1 and found[0].spelled and found[0].ends[-1] >= start + len(address), text
            base, added = pii.find(text, weights)
            if (at, dot) != ("@", "."):  # the pattern's own
                assert (start, start + len(address), 0) in added, (text, added)
    for text in ("we met at noon. then we left", "open at 10.30 today", "sold at 3.5 million", "look at version 2.0 now", "We stayed at home.\nLater it rained"):
        assert pii.find(text, weights)[1] == [], text


def test_plain_numbers_are_left_alone(weights):
    for text in ("In 2021-03-04 it cost 12 500 000 for 3.14.15 units", "order 1234567 and 99 88 77", "version 1.2.3.4.5.6", "no numbers at all, meet at home. dot", ""):
        assert pii.find(text, weights)[1] == [], text


def test_decoding_is_the_best_segmentation(weights):
    """Against all segmentations of short windows."""

    def best(w, at):
        if at == len(w.starts):
            return 0.0
        scores = [best(w, at + 1)]
        for i, j, f in pii.segments(w):
            if i == at:
                scores.append(max(weights[k][f].sum() for k in pii._kinds(w)) - pii.MARGIN + best(w, j + 1))
        return max(scores)

    rng = np.random.default_rng(4)
    for _ in range(60):
        text, _ = pii._made_up(rng)
        for w in pii.windows(text, []):
            if len(w.starts) > 8:
                continue
            scored = {(i, j): f for i, j, f in pii.segments(w)}
            total = sum(weights[k][scored[i, j]].sum() - pii.MARGIN for i, j, k in pii.decode(w, weights))
            assert total == pytest.approx(best(w, 0))


def test_masking_and_edges(spark, documents, weights):
    docs = documents((1, None), (2, ""), (3, "é a@b.cc 1.2.3.4"), (3, "é a@b.cc 1.2.3.4"), (None, "x"))
    masked = pii.mask(docs, weights)
    assert masked.columns == docs.columns
    want = [(None, None), ("", 0), ("x", 1), ("é <EMAIL> <IP>", 14), ("é <EMAIL> <IP>", 14)]
    assert sorted(((r.text, r.n_chars) for r in masked.collect()), key=repr) == sorted(want, key=repr)
    rows = {r.doc_id: r for r in pii.detect(docs, weights).collect()}
    assert rows[3].base == "email:2:8,ip:9:16" and rows[3].n_email == 1 and rows[1].spans == ""
    assert pii.detect(docs.where("doc_id < 0"), weights).count() == 0


def test_very_long_numbers_and_lists_of_addresses(weights):
    zeros = "0" * 5000
    assert pii.base_spans(f"{zeros}.1.1.1 {zeros}256.1.1.1") == [(0, 5006, 1)]
    assert pii.base_spans("9" * 5000 + " " + "1" * 5000 + ".2.3.4") == []
    text = "1.2.3.4 " * 60_000
    begin = time.monotonic()
    base, added = pii.find(text, weights)
    assert len(base) == 60_000 and not added and time.monotonic() - begin < 30
    numbers = "(212) 555-0143 / 12-34 " * 3_000
    base, added = pii.find(numbers, weights)
    assert all(b <= c for (_, b, _), (c, _, _) in zip(added[:-1], added[1:], strict=True))


def test_taken_places_equal_comparing_all():
    rng = random.Random(5)
    spans = [(a, a + rng.randint(1, 9), 0) for a in (rng.randrange(300) for _ in range(40))]
    taken = pii.Taken(spans)
    for a in range(310):
        for n in (1, 4):
            assert taken.touches(a, a + n) == any(x < a + n and a < y for x, y, _ in spans)
    free = next(a for a in range(300) if not taken.touches(a, a + 1))
    taken.add(free, free + 1)
    assert taken.touches(free, free + 1) and taken.starts == sorted(taken.starts)


def test_weights_do_not_depend_on_batches_and_learn_from_text_rich_in_numbers(spark, documents):
    rng = random.Random(6)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rich = [(i, " and ".join(rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(4)}-{d(2)}-{d(2)}", d(9), f"{d(5)}/{d(4)}"]) for _ in range(40))) for i in range(60)]
    docs = documents(*rich, (None, "12345678"), (900, None))
    found = pii.leftover_windows(docs, most=300)
    assert len(found) == 300 and not any(re.fullmatch(r" [(]\d{3}[)] \d{3}-\d{4} ", x) for x in found)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert pii.leftover_windows(docs.repartition(7, "text"), most=300) == found
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    learned = pii.fit(docs, made_up=300)
    for text, kind in (("call (212) 555-0143 now", 3), ("jo at mailhost dot org", 0), ("pay 4111.1111.1111.1111 now", 2)):
        assert [k for *_, k in pii.find(text, learned)[1]] == [kind], text
    assert pii.find("order 20240131 of 2024-01-31", learned)[1] == []


# --- tokens and packing ------------------------------------------------------------------


def test_cached_words_equal_the_tokenizer(monkeypatch):
    monkeypatch.setattr("ledgerloom.llm.tokens.CACHED_WORDS", 20)
    words = WordTokenizer(default_tokenizer())
    texts = ["Plain words, here. Plain!", "a<|endoftext|>b <|startoftext|> c", "it's don't 12ab", "Á é é x y", "\u0085 a o ́a", " lead", "", "İstanbul ΑΣ ΣΑΣ.", "a\tb\rc", "Straße ªº µ ÿŸ Ā", "a\x1cb", "x...?! _y_ ***", "word " * 300 + " ".join(f"t{i}" for i in range(200))]
    for _ in range(2):
        for text, ids in zip(texts, words(texts), strict=True):
            assert ids.tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_cover_every_token_once(spark, documents):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 50, 200, 5000])))) for i in range(80)]
    texts += [(100, None), (101, ""), (None, "null id"), (7, texts[7][1])]
    rows = packing.pack(documents(*texts), shard_tokens=20_000).collect()
    words = WordTokenizer(default_tokenizer())
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(zlib.crc32(np.append(words([t or ""])[0], 1).astype("<u4").tobytes()))
    sequences = defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.ids) and 0 < r.length <= packing.WINDOW
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
    tokens = sum(r.length for r in rows)
    assert tokens / (len(sequences) * packing.WINDOW) > 0.9
    for i, marks in want.items():
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == sum({r.doc_tokens for r in pieces}) * len(marks)
        if len(marks) == 1:
            assert zlib.crc32(b"".join(bytes(r.ids) for r in pieces)) == marks[0]


def test_neighbours_share_windows():
    """Two topics in one shard: a window holds the texts that share the seed's terms."""
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(10, 60, 200) + 100 * (i % 2), 1).astype(np.uint16) for i in range(60)]
    idf = np.full(1 << 16, 1.0)
    pieces = packing.pack_shard(docs, idf, 200.0, window=800)
    topics = defaultdict(set)
    for doc, _, _, sequence, _ in pieces:
        topics[sequence].add(doc % 2)
    assert sum(len(t) == 1 for t in topics.values()) >= len(topics) - 2


def _plain_pack(docs, idf, mean, window, end):
    """Packing of one shard with every score worked out by the formula."""
    pieces, rest, used, sequence = [], [0] * len(docs), [False] * len(docs), 0
    for i, ids in enumerate(docs):
        while len(ids) - rest[i] >= window:
            pieces.append((i, rest[i], window, sequence, 0))
            rest[i], sequence = rest[i] + window, sequence + 1
        used[i] = rest[i] == len(ids)

    def score(seed, doc):
        total = 0.0
        for t in sorted(set(docs[seed].tolist()) - {end}):
            f = int((docs[doc] == t).sum())
            if f and idf[t] > 0:
                total += idf[t] * f * (packing.K1 + 1) / (f + packing.K1 * (1 - packing.B + packing.B * len(docs[doc]) / mean))
        return total

    seed = None
    while seed is not None or not all(used):
        seed = used.index(False) if seed is None else seed
        used[seed] = True
        near = [(-score(seed, d), d) for d in range(len(docs)) if not used[d]]
        queue, seed, filled = [seed, *[d for s, d in sorted(near) if s < 0]], None, 0
        while filled < window:
            if not queue:
                if all(used):
                    break
                queue.append(used.index(False))
            doc = queue.pop(0)
            used[doc] = True
            length = min(window - filled, len(docs[doc]) - rest[doc])
            pieces.append((doc, rest[doc], length, sequence, filled))
            rest[doc], filled = rest[doc] + length, filled + length
            seed = doc if rest[doc] < len(docs[doc]) else None
        sequence += 1
    return pieces


def test_packing_a_shard_equals_scoring_all_documents():
    rng = np.random.default_rng(4)
    for window in (64, 300):
        docs = [np.append(rng.integers(2, 80, rng.choice([0, 3, 20, 90, 700])), 1).astype(np.uint16) for _ in range(50)]
        docs += [docs[3], docs[9]]
        idf = np.zeros(1 << 16)
        idf[2:80] = np.maximum(0, rng.normal(1, 1, 78))
        got = packing.pack_shard(docs, idf, 60.0, window=window, end=1)
        assert [tuple(map(int, p)) for p in got] == _plain_pack(docs, idf, 60.0, window, 1)


def test_bm25_scores_equal_the_formula():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 30, rng.integers(1, 60)).astype(np.uint16) for _ in range(20)]
    idf = rng.random(1 << 16)
    index = packing.Index(docs, idf, 30.0, end=1)
    got = index.scores(index.terms[3])
    for i, d in enumerate(docs):
        want = 0.0
        for t in set(docs[3].tolist()) - {1}:
            f = int((d == t).sum())
            want += idf[t] * f * (packing.K1 + 1) / (f + packing.K1 * (1 - packing.B + packing.B * len(d) / 30.0))
        assert got[i] == pytest.approx(want)


def test_the_tokenizer_reads_small_batches(spark, documents, monkeypatch, tmp_path):
    """Whatever the texts' lengths: 200 texts of 1,000 characters are no batch of 200,000 bytes."""
    real, name, folder = packing.shared_tokenizer, "spark.sql.execution.arrow.maxBytesPerBatch", str(tmp_path)

    def watched(path):
        words = real(path)

        class Watched:
            size = words.size

            def encode(self, column):
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                    f.write(str(column.nbytes))
                yield from words.encode(column)

        return Watched()

    before = spark.conf.get(name)
    monkeypatch.setattr(packing, "shared_tokenizer", watched)
    monkeypatch.setattr(packing, "BATCH_BYTES", 10_000)
    docs = documents(*[(i, f"w{i} abcdefg " * 100) for i in range(200)]).coalesce(1)
    assert packing.pack(docs).select("doc_id").distinct().count() == 200
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert len(sizes) > 15 and max(sizes) < 15_000
    assert spark.conf.get(name) == before


def test_packing_an_empty_table(spark, documents):
    assert packing.pack(documents((1, "x")).where("doc_id < 0")).count() == 0

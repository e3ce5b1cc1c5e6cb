"""Personal data in texts: pattern spans, and a semi-Markov conditional random field that adds to them.

Patterns find plain e-mail addresses, IP addresses, card and phone numbers.  The random field
reads the places where digits or at-signs are left over.  A window is a row of groups
(numbers or words); any run of at most ``MOST_GROUPS`` groups may be an entity, scored as a
whole: digits, shape, separators, check digit, neighbours.  Dynamic programming over the
windows picks boundaries and kinds together.  Weights are learned by maximum likelihood
from made-up entities and from leftover numbers of a bounded sample, which are none.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

MOST_GROUPS = 12
SAMPLE_DOCS = 1_000
#: Leftover numbers that are learned as none.
LEFTOVERS = 2_000
MADE_UP = 700
EPOCHS, RATE, DECAY = 5, 0.3, 1e-3
#: How much better an added span must be than leaving its groups alone, in log odds.
MARGIN = 2.0
SEED = 8

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _small(digits: str) -> bool:
    """Whether a part of an address is at most 255, however many zeros lead it."""
    rest = digits.lstrip("0")
    return len(rest) <= 3 and int(rest or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in linear time: each at-sign, with what stands before it back to the last match."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[Span]:
    """``start, end, kind number`` of the pattern matches, by start, then kind."""
    out: list[Span] = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


class Taken:
    """Places of a text that spans take, as ascending intervals without overlap."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b, _ in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def touches(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)
        return i < len(self.starts) and self.starts[i] < b

    def add(self, a: int, b: int) -> None:
        """Takes a place that nothing touches."""
        i = bisect_right(self.ends, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


# --- windows and segments ---------------------------------------------------------

NUMBERS = re.compile(r"[+(]{0,2}[0-9]+(?:[ ().\-/]{1,3}[0-9]+)*")
GROUP = re.compile(r"[+(]{0,2}[0-9]+")
AT = r"(?: ?[\[(]at[\])] ?| at | ?@ ?)"
DOT = r"(?: ?[\[(]dot[\])] ?| dot | ?\. ?)"
SPELLED = re.compile(rf"[A-Za-z0-9_%+-]{{1,64}}(?:{DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,3}}{AT}[A-Za-z0-9-]{{1,64}}(?:{DOT}[A-Za-z0-9-]{{1,64}}){{1,4}}", re.I)
#: The end of every spelled address; texts without it are passed over.
SPELLED_MARK = re.compile(rf"{AT}[A-Za-z0-9-]{{1,64}}{DOT}[A-Za-z0-9-]", re.I)
WORD = re.compile(r"[A-Za-z0-9_%+-]+")


@dataclass
class Window:
    """Groups of a piece of text: starts and ends, and the kinds its runs may have."""

    text: str
    starts: list[int]
    ends: list[int]
    spelled: bool = False


def windows(text: str, base: list[Span]) -> Iterator[Window]:
    """Windows with groups that no base span touches."""
    taken = Taken(base)
    if DIGIT.search(text):
        for m in NUMBERS.finditer(text):
            if m.end() - m.start() < 7:
                continue
            groups = [(g.start(), g.end()) for g in GROUP.finditer(text, m.start(), m.end())]
            if base:
                groups = [g for g in groups if not taken.touches(*g)]
            if groups and sum(b - a for a, b in groups) >= 4:
                yield Window(text, [a for a, _ in groups], [b for _, b in groups])
    if SPELLED_MARK.search(text):
        for m in SPELLED.finditer(text):
            groups = [(g.start(), g.end()) for g in WORD.finditer(text, m.start(), m.end())]
            if not taken.touches(m.start(), m.end()):
                yield Window(text, [a for a, _ in groups], [b for _, b in groups], True)


FEATURES = 48


def features(w: Window, i: int, j: int) -> list[int] | None:
    """Whole-span features of groups ``i`` to ``j`` (both in), or None if they can be no entity."""
    a, b = w.starts[i], w.ends[j]
    if b - a > 80:
        return None
    piece = w.text[a:b]
    tight = 46 if (a and w.text[a - 1].isalnum()) or (b < len(w.text) and w.text[b].isalnum()) else 47
    if w.spelled:
        if not re.search(AT, piece, re.I):
            return None
        dots = len(re.findall(DOT, piece, re.I))
        last = piece[w.starts[j] - a :]
        dotted = 1 if re.search(r"[\[(]dot[\])]| dot ", piece, re.I) else 2 if re.search(r"\.\s|\s\.", piece) else 3
        local = 30 if "@" in piece else 31 if re.search(r"[\[(]at[\])]", piece, re.I) else 32
        return [33, dotted, local, 4 + 3 * (dotted - 1) + local - 30, 34 + min(dots, 3), 38 if last.isalpha() and 2 <= len(last) <= 6 else 39, 40 if i == 0 else 41, 42 if j == len(w.starts) - 1 else 43, tight]
    digits = "".join(c for c in piece if c.isdigit())
    n, k = len(digits), j - i + 1
    if not 4 <= n <= 22:
        return None
    marks = set(re.sub(r"[0-9+(]", "", piece))
    sizes = [len(w.text[s:e].lstrip("+(")) for s, e in zip(w.starts[i : j + 1], w.ends[i : j + 1], strict=True)]
    dotted = k == 4 and piece.count(".") == 3 and marks == {"."}
    out = [0, 1 + min(7, (0 if n < 7 else 1 if n < 10 else 2 if n == 10 else 3 if n < 13 else 4 if n < 14 else 5 if n <= 16 else 6 if n <= 19 else 7))]
    out.append(9 + min(k, 5) - 1)
    out.append(14 if piece[0] == "+" else 15 if piece[0] == "(" else 16)
    out.append(17 if not marks else 18 if marks <= {" ", ")"} else 19 if marks <= {"-"} else 20 if marks == {"."} else 21 if "/" in marks else 22)
    if dotted:
        out.append(23 if all(int(x.lstrip("+(")) <= 255 for x in piece.split(".")) else 24)
    if 14 <= n <= 19:
        out.append(25 if luhn(digits) else 26)
    if sizes[-3:] == [3, 3, 4]:
        out.append(27)
    if len(sizes) > 1 and set(sizes) == {4}:
        out.append(28)
    if sizes == [4, 6, 5]:
        out.append(29)
    out.append(44 if i == 0 and j == len(w.starts) - 1 else 45)
    out.append(tight)
    return out


Segment = tuple[int, int, list[int]]


def segments(w: Window) -> list[Segment]:
    n = len(w.starts)
    return [(i, j, f) for i in range(n) for j in range(i, min(n, i + MOST_GROUPS)) if (f := features(w, i, j)) is not None]


def _kinds(w: Window) -> tuple[int, ...]:
    return (0,) if w.spelled else (1, 2, 3)


def decode(w: Window, weights: np.ndarray, margin: float = MARGIN) -> list[tuple[int, int, int]]:
    """The best segmentation: ``first group, last group, kind`` of its entities."""
    n, kinds = len(w.starts), list(_kinds(w))
    best = np.zeros(n + 1)
    back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
    ending: dict[int, list[tuple[int, list[int]]]] = {}
    for i, j, f in segments(w):
        ending.setdefault(j, []).append((i, f))
    for j in range(n):
        best[j + 1], back[j + 1] = best[j], (j, -1)
        for i, f in ending.get(j, ()):
            score = weights[kinds][:, f].sum(axis=1)
            k = int(score.argmax())
            if best[i] + score[k] - margin > best[j + 1]:
                best[j + 1], back[j + 1] = best[i] + score[k] - margin, (i, kinds[k])
    out, at = [], n
    while at:
        start, kind = back[at]
        if kind >= 0:
            out.append((start, at - 1, kind))
        at = start
    return out[::-1]


def _gradient(w: Window, gold: set[tuple[int, int, int]], weights: np.ndarray, out: np.ndarray) -> None:
    """Adds the gradient of the window's log likelihood: found features less expected ones."""
    n, kinds = len(w.starts), list(_kinds(w))
    found = segments(w)
    scores = [weights[kinds][:, f].sum(axis=1) for *_, f in found]
    begin: dict[int, list[int]] = {}
    end: dict[int, list[int]] = {}
    for s, (i, j, _) in enumerate(found):
        begin.setdefault(i, []).append(s)
        end.setdefault(j, []).append(s)
    alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    alpha[0] = beta[n] = 0
    for j in range(n):
        alpha[j + 1] = np.logaddexp.reduce([alpha[j], *[alpha[found[s][0]] + x for s in end.get(j, ()) for x in scores[s]]])
    for i in range(n - 1, -1, -1):
        beta[i] = np.logaddexp.reduce([beta[i + 1], *[beta[found[s][1] + 1] + x for s in begin.get(i, ()) for x in scores[s]]])
    for (i, j, f), score in zip(found, scores, strict=True):
        p = np.exp(np.clip(alpha[i] + score + beta[j + 1] - alpha[n], -50, 0))
        for k, kind in enumerate(kinds):
            out[kind, f] += float((i, j, kind) in gold) - p[k]


def _made_up(rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """A made-up text and its entities: usual and unusual writings, and numbers that are none."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(3, 8)))

    def card(sizes: tuple[int, ...], mark: str) -> str:
        body = str(rng.integers(3, 7)) + d(sum(sizes) - 2)
        digits = next(body + c for c in "0123456789" if luhn(body + c))
        cut = np.cumsum((0, *sizes))
        return mark.join(digits[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True))

    pick = lambda *x: x[int(rng.integers(0, len(x)))]
    parts: list[str] = []
    spans: list[tuple[int, int, int]] = []
    at = 0
    for _ in range(int(rng.integers(1, 4))):
        kind = int(rng.integers(-3, 4))
        if kind == 0:
            a, o = pick(" at ", "(at)", "[at]", " @ "), pick(" dot ", "(dot)", ".", "[dot]")
            piece = f"{name()}{pick('', '.' + name(), d(2))}{a}{name()}{o}{pick('com', 'org', 'net', 'de')}"
        elif kind == 1:
            piece = ".".join(str(x) for x in rng.integers(0, 256, 4))
        elif kind == 2:
            piece = card(*pick(((16,), ""), ((4, 4, 4, 4), " "), ((4, 4, 4, 4), "-"), ((4, 4, 4, 4), "."), ((4, 6, 5), " ")))
        elif kind == 3:
            piece = pick(f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"+{d(2)} {d(3)} {d(7)}", f"{d(3)}.{d(3)}.{d(4)}")
        else:
            piece = pick(d(8), d(10), d(12), d(16), d(20), f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(1)}.{d(1)}.{d(2)}", f"{d(3)}.{d(3)}", f"{d(2)} {d(3)} {d(3)}", f"{d(4)} {d(4)}", f"3{d(2)}.{d(3)}.9{d(2)}.{d(3)}", f"{name()} at {name()}. {name()}", f"{d(5)}-{d(4)}")
        if kind >= 0:
            spans.append((at, at + len(piece), kind))
        gap = pick(f" {name()} ", f" {name()} {name()}. ", ", ")
        parts += [piece, gap]
        at += len(piece) + len(gap)
    return "".join(parts), spans


def likely_entity(w: Window) -> bool:
    """Whether a run of the window is written like a phone or card number that the patterns miss, so that it teaches nothing as none."""
    for i, j, f in segments(w):
        digits = sum(c.isdigit() for c in w.text[w.starts[i] : w.ends[j]])
        if (27 in f and 10 <= digits <= 15) or (14 in f and 10 <= digits <= 15) or 25 in f:
            return True
    return False


def leftover_windows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, most: int = LEFTOVERS) -> list[str]:
    """At most ``most`` numbers that no pattern takes and that are not written like an entity, with a space around them.

    They come from documents of at most ``sample_docs`` ids, drawn by a hash of the id, and are drawn by a hash of document and
    place, so neither batches nor the order of rows matter.
    """

    def leftovers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, x in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text, piece, place = x.as_py() or "", [], []
                for w in windows(text, base_spans(text)):
                    if not w.spelled and len(w.starts) <= MOST_GROUPS:
                        around = " " + text[w.starts[0] : w.ends[-1]] + " "
                        if not any(likely_entity(v) for v in windows(around, [])):
                            piece.append(around)
                            place.append(w.starts[0])
                columns = [pa.array([doc.as_py()] * len(piece), doc.type), pa.array(place, pa.int64()), pa.array(piece, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "piece"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    found = sample.mapInArrow(leftovers, f"doc_id {kind}, place bigint, piece string")
    drawn = found.orderBy(F.xxhash64("doc_id", "place"), "doc_id", "place", "piece").limit(most)
    return sorted(r.piece for r in drawn.collect())


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, made_up: int = MADE_UP, seed: int = SEED) -> np.ndarray:
    """Weights of the random field: kinds by features.

    ``made_up`` texts bring entities; :func:`leftover_windows` of a bounded sample are labelled as none.  Only those windows
    reach the driver.
    """
    none = leftover_windows(docs, sample_docs)
    rng = np.random.default_rng(seed)
    examples: list[tuple[Window, set]] = []
    for text, spans in [(t, []) for t in none] + [_made_up(rng) for _ in range(made_up)]:
        for w in windows(text, []):
            at = {(w.starts[i], w.ends[j]): (i, j) for i in range(len(w.starts)) for j in range(i, min(len(w.starts), i + MOST_GROUPS))}
            gold = {(*at[a, b], k) for a, b, k in spans if (a, b) in at and k in _kinds(w)}
            examples.append((w, gold))
    weights = np.zeros((len(KINDS), FEATURES))
    weights[:, [0, 33]] = -1.0
    total = np.full_like(weights, 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), 16):
            grad = -DECAY * weights
            for e in order[at : at + 16]:
                _gradient(*examples[e], weights, grad)
            total += grad * grad
            weights += RATE * grad / np.sqrt(total)
    return weights


def find(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans the random field adds beside them."""
    base = base_spans(text)
    taken, added = Taken(base), []
    for w in windows(text, base):
        for i, j, kind in decode(w, weights):
            a, b = w.starts[i], w.ends[j]
            if not taken.touches(a, b):
                taken.add(a, b)
                added.append((a, b, kind))
    return base, added


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


def detect(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, base, spans`` (``kind:start:end`` by start, code points) and base counts per kind.

    Null and empty texts have no spans.  Repeated rows give equal results, an empty table an
    empty one; only ``doc_id`` and ``text`` are read.
    """

    def spotted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base_text, all_text, counts = [], [], []
            for x in batch.column("text"):
                base, added = find(x.as_py() or "", weights)
                base_text.append(_written(base))
                all_text.append(_written(base + added))
                counts.append([sum(k == n for *_, k in base) for n in range(len(KINDS))])
            columns = [pa.array([c[n] for c in counts], pa.int64()) for n in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(base_text, pa.string()), pa.array(all_text, pa.string())], ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(spotted, f"doc_id {kind}, {counts}, base string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in capitals; overlapping spans fall under the first."""
    out, at = [], 0
    for a, b, k in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, ``n_chars`` brought up to date where there is such a column.

    Null texts stay null, empty ones empty; texts are read whole, however long.  Repeated rows are replaced alike, an empty table gives an
    empty one.  All other columns stay as they are, whatever their names.
    """
    names = docs.columns

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for x in batch.column("text"):
                text = x.as_py()
                base, added = find(text or "", weights)
                texts.append(masked(text, base + added) if base or added else text)
            kind = batch.schema.field("text").type
            yield pa.RecordBatch.from_arrays([pa.array(texts, kind) if n == "text" else batch.column(n) for n in names], names)

    out = docs.mapInArrow(cleaned, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out

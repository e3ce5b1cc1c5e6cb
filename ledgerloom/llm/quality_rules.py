"""Quality rules as a short-circuit cascade, DataFrame functions only.

Each rule's cost and share of rejections are estimated on a bounded sample; rules are then
ordered by rejections per cost and chained in one CASE expression, so that a document
stops at the first rule that rejects it.  The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import SPACE, let, words

SAMPLE_ROWS = 1_000
SEED = 6
Features = Callable[[str], Column]


def _has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACE))) > 0


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), _has_word)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _covered(places: Column) -> Column:
    """Words under 3-word windows that start at these ascending places."""
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), step, lambda a: a["n"])


#: Up to so many repeated windows are looked up one by one; with more, windows are sorted with their places.
FEW_REPEATS = 32
#: Passes over the sample for each rule, and the least cost that tells rules apart.
PASSES = 3
LEAST_SECONDS = 1e-3


def _repeat_words(word: Column) -> Column:
    """Words inside 3-word windows found twice or more; windows are compared by a 64-bit hash."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(word) - 2),
        lambda i: F.xxhash64(F.element_at(word, i), F.element_at(word, i + 1), F.element_at(word, i + 2)),
    )

    def few(h: Column, twice: Column) -> Column:
        at = F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i))
        return _covered(F.filter(at, lambda i: i.isNotNull()))

    def many(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            same = lambda i, j: F.get(p, i)["h"] == F.get(p, j)["h"]
            own = F.transform(
                p,
                lambda x, i: F.when(F.coalesce(same(i, i + 1), F.lit(False)) | F.coalesce((i > 0) & same(i, F.greatest(i - 1, F.lit(0))), F.lit(False)), x["i"]),
            )
            return F.sort_array(F.filter(own, lambda i: i.isNotNull()))

        return _covered(let(pairs, places))

    def marked(h: Column) -> Column:
        def with_sorted(s: Column) -> Column:
            hit = F.filter(F.transform(s, lambda x, i: F.when((i > 0) & (x == F.get(s, F.greatest(i - 1, F.lit(0)))), x)), lambda x: x.isNotNull())
            return let(F.array_distinct(hit), lambda t: F.when(F.size(t) <= FEW_REPEATS, few(h, t)).otherwise(many(h)))

        alone = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(alone, F.lit(0)).otherwise(let(F.sort_array(h), with_sorted))

    return F.when(F.size(word) < 4, F.lit(0)).otherwise(let(windows, marked)).cast("long")


def feature(name: str, text: Column, word: Column) -> Column:
    """One of the features the rules use, of a text and its words."""
    text = F.coalesce(text, F.lit(""))
    return {
        "n_words": lambda: F.size(word).cast("long"),
        "word_chars": lambda: F.length(F.array_join(word, "")).cast("long"),
        "n_symbols": lambda: F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": lambda: _dup_lines(text),
        "n_repeat_words": lambda: _repeat_words(word),
        "n_lines": lambda: F.size(F.filter(F.split(text, "\n"), _has_word)).cast("long"),
        "n_upper": lambda: F.regexp_count(text, F.lit("\\p{Lu}")).cast("long"),
    }[name]()


BASE_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rejection test over features."""

    name: str
    rejects: Callable[[Features], Column]


#: The two base rules first; the others reject junk only: symbol runs, copied lines, odd word lengths, shouting.
RULES = (
    Rule("few_words", lambda f: f("n_words") < 50),
    Rule("repeats", lambda f: 100 * f("n_repeat_words") > 50 * f("n_words")),
    Rule("symbols", lambda f: 5 * f("n_symbols") > f("n_words")),
    Rule("copied_lines", lambda f: 2 * f("n_dup_lines") > f("n_lines")),
    Rule("word_length", lambda f: (f("word_chars") < 2 * f("n_words")) | (f("word_chars") > 14 * f("n_words"))),
    Rule("shouting", lambda f: 2 * f("n_upper") > f("word_chars")),
)
BASE_RULES = ("few_words", "repeats")


def _inline(f: str) -> Column:
    return feature(f, F.col("row.text"), F.col("_words"))


def _with_words(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("_words", words(F.col("row.text")))


def _seconds(rows: DataFrame, test: Column) -> tuple[float, int]:
    """The shortest of a few passes that count the rows where ``test`` holds, and their number."""
    times = []
    for _ in range(PASSES):
        began = time.perf_counter()
        n = rows.where(test).count()
        times.append(time.perf_counter() - began)
    return min(times), n


def order_rules(docs: DataFrame, rules=RULES, rows: int = SAMPLE_ROWS, seed: int = SEED) -> list[Rule]:
    """``rules`` by rejections per second, the best first, measured on about ``rows`` documents.

    The sample is drawn row by row from all files and only decides the order.  A rule's cost is the time of its pass beyond that
    of a pass without a rule, so that the fixed time of a job hides no rule.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = _with_words(docs.select("text").sample(fraction=min(1.0, rows / total), seed=seed)).persist()
    try:
        n = max(1, sample.count())
        empty, _ = _seconds(sample, F.size("_words") >= 0)
        scored = []
        for rule in rules:
            spent, rejected = _seconds(sample, rule.rejects(_inline))
            scored.append((-(rejected + 0.5) / n / max(spent - empty, LEAST_SECONDS), len(scored), rule))
        return [rule for *_, rule in sorted(scored, key=lambda x: x[:2])]
    finally:
        sample.unpersist()


def first_rejection(rules: list[Rule], features: Features) -> Column:
    """The first rule of the list that rejects, null if none does; later rules are not evaluated."""
    chain = F
    for rule in rules:
        chain = chain.when(rule.rejects(features), F.lit(rule.name))
    return chain


def cascade(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``row`` (all columns of a document) and ``rejected_by``, null for documents that pass.

    Null, empty and blank texts have no words and fall to ``few_words``.  Repeated rows are
    judged alike; an empty table gives an empty result.  The columns of ``docs`` sit in one
    struct, so no name can clash.  A null comparison never rejects.
    """
    ordered = order_rules(docs, rules, sample_rows)
    text = F.col("row.text")
    # The words are bound inside the expression: as a column, a filter above would work them out again and again.
    verdict = let(words(text), lambda w: first_rejection(ordered, lambda f: feature(f, text, w)))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select("row", verdict.alias("rejected_by"))


def passing(docs: DataFrame, **options) -> DataFrame:
    """The documents no rule rejects, with their own columns."""
    return cascade(docs, **options).where(F.col("rejected_by").isNull()).select("row.*")


def judged(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """As ``cascade``, with the base features as columns, each worked out once.

    All other features stand inside the verdict and are worked out only for documents that get as far as their rule.
    """
    ordered = order_rules(docs, rules, sample_rows)
    rows = _with_words(docs).select("row", "_words", *[_inline(n).alias(n) for n in BASE_FEATURES])
    verdict = first_rejection(ordered, lambda f: F.col(f) if f in BASE_FEATURES else _inline(f))
    return rows.select("row", *BASE_FEATURES, verdict.alias("rejected_by"))

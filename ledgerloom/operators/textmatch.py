"""Question-and-answer records: splitting, merging and fuzzy lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import edit_similarity, normalised, strip_all

# Fixed value: the line above each record of an exported result list.
QUESTION_LINE = "Question"


def blank_line() -> Column:
    """Whether a line is blank."""
    return strip_all("value") == ""


def marker_line(marker: str = QUESTION_LINE) -> Column:
    """Whether a line is the marker."""
    return strip_all("value") == marker


def cut_records(df: DataFrame, text: str, separator: str, *ids: str) -> DataFrame:
    """Long text column to one row per record: ids, ``position`` (from 0), ``value``."""
    parts = F.split(F.col(text), "\\Q" + separator + "\\E")
    return df.select(*ids, F.posexplode(parts).alias("position", "value"))


def _question_parts(
    records: DataFrame, answer_mark: str, options_pattern: str
) -> tuple[DataFrame, Column]:
    halves = F.split(F.col("value"), "\\Q" + answer_mark + "\\E")
    staged = records.withColumn("_halves", halves)
    pieces = F.split(F.get("_halves", 0), options_pattern)
    return staged.withColumn("_pieces", pieces), F.size("_halves") == 2


def split_questions(
    records: DataFrame, answer_mark: str = "|", options_pattern: str = r"[?]+"
) -> DataFrame:
    """Good records as ``questions, options, answers`` next to their other columns.

    A good record has exactly one answer mark.  Its first half is cut by the option
    pattern; when that does not give exactly two pieces, the whole half is the
    question and the options are empty.
    """
    staged, good = _question_parts(records, answer_mark, options_pattern)
    paired = F.size("_pieces") == 2
    half = F.get("_halves", 0)
    return (
        staged.where(good)
        .withColumns(
            {
                "questions": F.when(paired, F.get("_pieces", 0)).otherwise(half),
                "options": F.when(paired, F.get("_pieces", 1)).otherwise(F.lit("")),
                "answers": F.get("_halves", 1),
            }
        )
        .drop("value", "_halves", "_pieces")
    )


def quarantined_records(records: DataFrame, answer_mark: str = "|") -> DataFrame:
    """Records without exactly one answer mark, unchanged."""
    marks = F.size(F.split(F.col("value"), "\\Q" + answer_mark + "\\E"))
    return records.where(marks != 2)


def _body(records: DataFrame) -> DataFrame:
    """Records of several lines with ``_body``, their lines that are not blank."""
    return records.withColumn("_body", F.filter("lines", lambda line: strip_all(line) != ""))


def split_blocks(records: DataFrame) -> DataFrame:
    """Records between blank lines as ``file, first_line, questions, options, answers``.

    The first line is the question and the others are its options, one per line; no answer is marked, so it is empty.
    Pass records gathered with a border at blank lines (:func:`blank_line`).
    """
    good = _body(records).where(F.size("_body") > 1)
    options = F.array_join(F.slice("_body", 2, F.size("_body")), "\n")
    return good.select("file", "first_line", F.get("_body", 0).alias("questions"), options.alias("options"), F.lit("").alias("answers"))


def quarantined_blocks(records: DataFrame) -> DataFrame:
    """Records between blank lines with a question alone, and those too long to be gathered, unchanged."""
    bad = F.col("lines").isNull() | (F.size("_body") == 1)
    return _body(records).where(bad).drop("_body")


def _marked_halves(records: DataFrame, marker: str) -> tuple[DataFrame, Column]:
    body = F.when(strip_all(F.get("lines", 0)) == marker, F.array_join(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))), "\n"))
    staged = records.withColumn("_halves", F.split(body, "\t"))
    return staged, F.coalesce(F.size("_halves") == 2, F.lit(False))


def split_marked(records: DataFrame, marker: str = QUESTION_LINE) -> DataFrame:
    """Records below marker lines as ``file, first_line, questions, options, answers``.

    A good record holds exactly one tab, with the question before it and the answers behind it; there are no options.  Pass
    records gathered with a border at the marker (:func:`marker_line`).
    """
    staged, good = _marked_halves(records, marker)
    halves = [F.get("_halves", 0).alias("questions"), F.lit("").alias("options"), F.get("_halves", 1).alias("answers")]
    return staged.where(good).select("file", "first_line", *halves)


def quarantined_marked(records: DataFrame, marker: str = QUESTION_LINE) -> DataFrame:
    """Records without exactly one tab, lines before the first marker, and records too long to be gathered, unchanged."""
    staged, good = _marked_halves(records, marker)
    return staged.where(~good).drop("_halves")


def dedupe_by_text(df: DataFrame, text: str, *order: Column | str) -> DataFrame:
    """One row per normalised text, the first in ``order``; the text comes out normalised.

    Rows are grouped by a digest of the text.  Asking only for the first row lets
    Spark drop later copies inside each map task, so even a text that makes up a
    third of the table sends one row per task to the shuffle.
    """
    prepared = df.withColumn(text, normalised(text)).withColumn("_digest", F.sha2(text, 256))
    first = Window.partitionBy("_digest").orderBy(*order)
    return (
        prepared.withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") == 1)
        .drop("_place", "_digest")
    )


def closest(
    df: DataFrame,
    text: str,
    question: str,
    top: int = 10,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The ``top`` rows whose text is most like ``question``, with ``score``.

    One pass without any join: every task scores its rows and keeps its own best,
    and only those meet.  Likeness is the edit distance over the longer length.
    """
    scored = df.withColumn("score", edit_similarity(text, question))
    return scored.orderBy(F.desc_nulls_last("score"), *(tie_break or [])).limit(top)


def closest_each(
    df: DataFrame,
    text: str,
    questions: list[str],
    top: int = 10,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """:func:`closest` for several questions in one pass: adds ``question``, ``place``.

    The questions are constants of the plan, so there is no join.  Asking for the
    first places only lets each map task keep its own best rows per question.
    """
    scores = F.array(
        *[
            F.struct(F.lit(q).alias("question"), edit_similarity(text, q).alias("score"))
            for q in questions
        ]
    )
    best = Window.partitionBy("question").orderBy(
        F.desc_nulls_last("score"), *(tie_break or [])
    )
    return (
        df.select("*", F.inline(scores))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= top)
    )

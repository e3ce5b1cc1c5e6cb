"""Threshold-based quality rules.

A run gives one row per rule: ``rule, target, total, passed, pct, status, critical,
accepted``.  ``pct`` is cut (never rounded up) to four decimals.  Below the minimum
threshold a rule is ``KO``, below the target ``WARN``, else ``OK``; ``accepted``
compares with the acceptance minimum.  All rules on the checked frame share one
pass over it, and each other dataset is read once.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_date
from ledgerloom.sources.files import listed_partitions, path_exists, read_zone


class QualityFailure(RuntimeError):
    """A critical rule ended KO."""


@dataclass(frozen=True)
class Rule:
    """Common thresholds, in percent; ``with_refusals`` asks a job to store the rows that fail."""

    acceptance_min: float = 100.0
    min_threshold: float = 100.0
    target_threshold: float = 100.0
    critical: bool = True
    with_refusals: bool = False

    @property
    def kind(self) -> str:
        return type(self).__name__

    @property
    def target(self) -> str:
        return "*"

    def ok(self) -> Column | None:
        """Row condition, for rules that count passing rows."""
        return None

    def other(self) -> DataFrame | None:
        """One row with the expected count, for rules that compare two counts."""
        return None


@dataclass(frozen=True)
class NotEmpty(Rule):
    """The dataset can be read and holds rows."""


@dataclass(frozen=True)
class MatchesControlCount(Rule):
    """As many rows as the control frame's ``expected`` says."""

    control: DataFrame | None = None

    @property
    def target(self) -> str:
        return "control"

    def other(self) -> DataFrame:
        return self.control.select(F.col("expected").cast("bigint").alias("n"))


@dataclass(frozen=True)
class MatchesDatasetCount(Rule):
    """As many rows as another dataset, perhaps filtered by a SQL condition."""

    dataset: DataFrame | None = None
    condition: str | None = None

    @property
    def target(self) -> str:
        return self.condition or "dataset"

    def other(self) -> DataFrame:
        kept = self.dataset.where(F.expr(self.condition)) if self.condition else self.dataset
        return kept.agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class NotNull(Rule):
    """All the named columns are filled."""

    columns: tuple[str, ...] = ()

    @property
    def target(self) -> str:
        return ",".join(self.columns)

    def ok(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns])


@dataclass(frozen=True)
class DateEquals(Rule):
    """A date column holds the expected date, given as an ISO date or a midnight."""

    column: str = ""
    value: str = ""

    @property
    def target(self) -> str:
        return self.column

    def ok(self) -> Column:
        moment = datetime.fromisoformat(self.value)
        if moment.time() != time(0):
            raise ValueError(f"{self.value!r} is no date")
        return F.col(self.column) == as_date(moment.date().isoformat())


@dataclass(frozen=True)
class MatchesPattern(Rule):
    """A column matches a regular expression."""

    column: str = ""
    pattern: str = "^[a-zA-Z]+$"

    @property
    def target(self) -> str:
        return self.column

    def ok(self) -> Column:
        return F.col(self.column).rlike(self.pattern)


@dataclass(frozen=True)
class MaxLength(Rule):
    """Text is no longer than the schema allows (null passes)."""

    column: str = ""
    limit: int = 0

    @property
    def target(self) -> str:
        return self.column

    def ok(self) -> Column:
        return F.col(self.column).isNull() | (F.length(self.column) <= self.limit)


def length_rules(limits: dict[str, int], **thresholds: object) -> list[Rule]:
    """One :class:`MaxLength` per limited column."""
    return [MaxLength(column=c, limit=n, **thresholds) for c, n in limits.items()]


def _expected(rule: Rule) -> Column:
    """The other count as a scalar subquery, null for row rules; anything but one row in a control frame is refused."""
    other = rule.other()
    if other is None:
        return F.lit(None).cast("bigint")
    if not isinstance(rule, MatchesControlCount):  # a count is one row by itself
        return F.coalesce(other.scalar(), F.lit(0)).cast("bigint")
    wrong = F.raise_error(F.concat(F.lit(f"{rule.kind} needs one control row, found "), F.count("*").cast("string")))
    one = F.when(F.count("*") == 1, F.max("n")).otherwise(wrong.cast("bigint"))
    return F.coalesce(other.agg(one.alias("n")).scalar(), F.lit(0)).cast("bigint")


def _counters(rules: list[Rule]) -> list[Column]:
    """``total``, and ``passed_i`` of every row rule."""
    passed = [F.count_if(rule.ok()).alias(f"passed_{i}") for i, rule in enumerate(rules) if rule.ok() is not None]
    return [F.count("*").alias("total"), *passed]


def evaluate(df: DataFrame, rules: list[Rule], subset: str | None = None) -> DataFrame:
    """Report of all rules on the frame (or on its ``subset``)."""
    checked = df.where(F.expr(subset)) if subset else df
    return _report(checked.agg(*_counters(rules)), rules)


def rules_text(rules: list[Rule]) -> str:
    """What the row rules count, as text; thresholds are not part of it."""
    return "; ".join(f"{i} {rule.kind} {rule.ok()}" for i, rule in enumerate(rules) if rule.ok() is not None)


def partition_counters(df: DataFrame, rules: list[Rule], partition: str) -> DataFrame:
    """One row of counters per partition value: ``partition`` (text), ``rules``, ``total, passed_i``.

    Counters add up, so rows of disjoint partitions are the state of a table's quality: store them, and count only partitions that
    are not among them (:func:`unseen_partitions`).
    """
    value = F.col(partition).cast("string").alias("partition")
    counted = df.groupBy(value).agg(*_counters(rules))
    return counted.select("partition", F.lit(rules_text(rules)).alias("rules"), *[c for c in counted.columns if c != "partition"])


def unseen_partitions(spark: SparkSession, path: str, column: str, state: DataFrame) -> list[str | None]:
    """Partition values of a stored table that a state does not hold, from the listing; one text per partition reaches the driver."""
    known = state.select(F.col("partition").alias("value")).distinct()
    listed = listed_partitions(spark, path, column).select("value")
    same = listed["value"].eqNullSafe(known["value"])
    return sorted((r.value for r in listed.join(known, same, "left_anti").collect()), key=lambda v: (v is None, v))


def update_counters(spark: SparkSession, path: str, column: str, rules: list[Rule], state_path: str) -> list[str | None]:
    """Counts the partitions of a stored table that the state below ``state_path`` lacks, and adds them to it.

    Only those partitions are read.  Returns their values; nothing is written when there are none.  A partition that was replaced
    after it was counted must be taken out of the state first (:func:`forget_partitions`).
    """
    table = read_zone(spark, path)
    empty = partition_counters(table.where(F.lit(False)), rules, column)
    state = spark.read.schema(empty.schema).parquet(state_path) if path_exists(spark, state_path) else empty
    values = unseen_partitions(spark, path, column, state)
    if values:
        kind = table.schema[column].dataType
        wanted = F.col(column).isin([F.lit(v).cast(kind) for v in values if v is not None])
        if None in values:
            wanted = wanted | F.col(column).isNull()
        partition_counters(table.where(wanted), rules, column).write.mode("append").parquet(state_path)
    return values


def forget_partitions(spark: SparkSession, state_path: str, values: list[str], new_path: str) -> None:
    """The state without some partitions, written to a new place, so that they are counted again."""
    state = spark.read.parquet(state_path)
    state.where(~F.coalesce(F.col("partition").isin(values), F.lit(False))).write.parquet(new_path)


def evaluate_state(state: DataFrame, rules: list[Rule]) -> DataFrame:
    """:func:`evaluate` from stored counters; counters of other rules are refused."""
    wanted = F.lit(rules_text(rules))
    other = F.raise_error(F.concat(F.lit("the state counts other rules: "), F.col("rules")))
    checked = F.when(F.col("rules") == wanted, F.col("total")).otherwise(other.cast("bigint"))
    sums = [F.coalesce(F.sum(checked), F.lit(0)).alias("total")]
    sums += [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in state.columns if c.startswith("passed_")]
    return _report(state.agg(*sums), rules)


def _report(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """Report from one row of counters."""
    facts = [
        F.struct(
            F.lit(i).alias("rule_no"),
            F.lit(rule.kind).alias("rule"),
            F.lit(rule.target).alias("target"),
            F.lit(rule.critical).alias("critical"),
            F.lit(rule.acceptance_min).alias("acceptance_min"),
            F.lit(rule.min_threshold).alias("min_threshold"),
            F.lit(rule.target_threshold).alias("target_threshold"),
            F.lit(rule.ok() is None and rule.other() is None).alias("non_empty"),
            F.col("total").alias("total"),
            (F.col(f"passed_{i}") if rule.ok() is not None else F.lit(None).cast("bigint")).alias(
                "counted"
            ),
            _expected(rule).alias("expected"),
        )
        for i, rule in enumerate(rules)
    ]
    lines = counted.select(F.inline(F.array(*facts)))

    # Two counts agree to the share of the smaller in the larger one.
    total = F.when(F.col("expected").isNotNull(), F.greatest("total", "expected")).otherwise(
        F.col("total")
    )
    passed = (
        F.when(F.col("expected").isNotNull(), F.least("total", "expected"))
        .when(F.col("non_empty"), F.col("total"))
        .otherwise(F.col("counted"))
    )
    empty_pct = F.when(F.col("non_empty"), F.lit(0)).otherwise(F.lit(1_000_000))
    share = F.expr("CASE WHEN total > 0 THEN passed * 1000000 div total END")
    return (
        lines.select("*", total.alias("_total"), passed.alias("_passed"))
        .drop("total")
        .withColumnsRenamed({"_total": "total", "_passed": "passed"})
        .withColumn("_share", F.coalesce(share, empty_pct.cast("bigint")))
        .withColumn("pct", (F.col("_share") / F.lit(10_000)).cast("decimal(9,4)"))
        .select(
            "rule",
            "target",
            "total",
            "passed",
            "pct",
            F.when(F.col("pct") < F.col("min_threshold"), "KO")
            .when(F.col("pct") < F.col("target_threshold"), "WARN")
            .otherwise("OK")
            .alias("status"),
            "critical",
            (F.col("pct") >= F.col("acceptance_min")).alias("accepted"),
        )
    )


def refusals(df: DataFrame, rules: list[Rule], subset: str | None = None) -> DataFrame:
    """Rows that fail a row rule, once per failed rule, with ``refused_by``."""
    checked = df.where(F.expr(subset)) if subset else df
    row_rules = [r for r in rules if r.ok() is not None]
    if not row_rules:
        return checked.withColumn("refused_by", F.lit("")).where(F.lit(False))
    failed = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(r.ok(), F.lit(False)), F.lit(f"{r.kind}({r.target})"))
                for r in row_rules
            ]
        )
    )
    return checked.withColumn("refused_by", F.explode(failed))


def enforce(report: DataFrame) -> DataFrame:
    """The report, after stopping the job when a critical rule is KO."""
    bad = report.where(F.col("critical") & (F.col("status") == "KO")).collect()
    if bad:
        raise QualityFailure(
            "; ".join(f"{r['rule']}({r['target']}): {r['pct']}%" for r in bad)
        )
    return report


def acceptance(output: DataFrame, source: DataFrame, more_columns: bool = False) -> DataFrame:
    """Acceptance checks of a job: ``check, ok`` for non-empty, same rows, columns.

    The master zone must have as many columns as its input, the raw zone
    (``more_columns``) must have more.
    """
    have, want = len(output.columns), len(source.columns)
    columns_ok = have > want if more_columns else have == want
    sides = output.agg(F.count("*").alias("n")).select(F.lit("output").alias("side"), "n").unionByName(
        source.agg(F.count("*").alias("n")).select(F.lit("input").alias("side"), "n")
    )
    counts = sides.agg(
        F.max(F.when(F.col("side") == "output", F.col("n"))).alias("n_out"),
        F.max(F.when(F.col("side") == "input", F.col("n"))).alias("n_in"),
    )
    checks = F.array(
        F.struct(F.lit("not_empty").alias("check"), (F.col("n_out") > 0).alias("ok")),
        F.struct(F.lit("same_records").alias("check"), (F.col("n_out") == F.col("n_in")).alias("ok")),
        F.struct(F.lit("column_count").alias("check"), F.lit(columns_ok).alias("ok")),
    )
    return counts.select(F.inline(checks))


def files_per_directory(
    spark: SparkSession, path: str, max_files: int = 100, ending: str = "parquet"
) -> DataFrame:
    """Per partition directory: number of data files, their size in MB, the limit kept.

    The binary-file source gives one row per file and, as the content is not asked
    for, opens none of them; the table's rows are never scanned.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{ending}")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    directory = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return (
        listed.groupBy(directory.alias("directory"))
        .agg(
            F.count("*").alias("files"),
            (F.sum("length") / F.lit(1024 * 1024)).alias("size_mb"),
        )
        .withColumn("ok", F.col("files") < max_files)
    )

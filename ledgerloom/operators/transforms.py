"""Column transforms for ``df.transform``: each returns a ``DataFrame -> DataFrame``."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Transform = Callable[[DataFrame], DataFrame]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Column names that match the whole pattern."""
    return [c for c in df.columns if re.fullmatch(pattern, c)]


def columns_containing(df: DataFrame, text: str) -> list[str]:
    """Column names that contain ``text``."""
    return [c for c in df.columns if text in c]


def _replace(df: DataFrame, names: list[str], change: Callable[[str], Column]) -> DataFrame:
    chosen = set(names)
    return df.select(*[change(c).alias(c) if c in chosen else F.col(c) for c in df.columns])


def sql_filter(predicate: str) -> Transform:
    """Rows that meet a SQL predicate."""
    return lambda df: df.where(F.expr(predicate))


def select_columns(*names: str) -> Transform:
    return lambda df: df.select(*names)


def literal(name: str, value: object, type_: str = "string") -> Transform:
    """A constant column."""
    return lambda df: df.withColumn(name, F.lit(value).cast(type_))


def trim_columns(pattern: str = ".*", side: str = "both") -> Transform:
    """Spaces trimmed from the matching columns."""
    trims = {"both": F.trim, "left": F.ltrim, "right": F.rtrim}
    return lambda df: _replace(df, columns_matching(df, pattern), trims[side])


def replace_text(pattern: str, replacements: Mapping[str, str]) -> Transform:
    """Regular-expression replacements, in order, over the matching columns as text."""

    def change(name: str) -> Column:
        value = F.col(name).cast("string")
        for found, new in replacements.items():
            value = F.regexp_replace(value, found, new)
        return value

    return lambda df: _replace(df, columns_matching(df, pattern), change)


def cast_columns(pattern: str, type_: str) -> Transform:
    """Strict casts: text that does not fit fails the job instead of becoming null."""
    spark_type = {"int32": "int"}.get(type_, type_)
    return lambda df: _replace(
        df, columns_matching(df, pattern), lambda c: F.col(c).cast(spark_type)
    )


def _date(name: str, format_: str, strict: bool, locale: str | None) -> Column:
    if locale is None:
        return F.to_date(name, format_) if strict else F.try_to_date(name, format_)
    options = {"dateFormat": format_, "locale": locale, "mode": "FAILFAST" if strict else "PERMISSIVE", "sep": "\u0001", "quote": ""}
    return F.from_csv(F.col(name), "value date", options)["value"]


def parse_dates(pattern: str, format_: str | list[str], strict: bool = True, locale: str | None = None) -> Transform:
    """Dates read in an explicit format; ``strict=False`` nulls what does not parse.

    Of several formats the first that fits counts.  ``locale`` (such as ``es-MX``) is the language of month and day names.
    """
    formats = [format_] if isinstance(format_, str) else list(format_)

    def parse(name: str) -> Column:
        tried = [_date(name, f, False, locale) for f in formats[:-1]]
        return F.coalesce(*tried, _date(name, formats[-1], strict, locale))

    return lambda df: _replace(df, columns_matching(df, pattern), parse)


def decimal_comma_to_point(text: str = "amount") -> Transform:
    """Commas turned into points in the columns whose name contains ``text``."""
    return lambda df: _replace(
        df, columns_containing(df, text), lambda c: F.regexp_replace(c, ",", ".")
    )


def truncate(name: str, length: int) -> Transform:
    """The first ``length`` characters of a column."""
    return lambda df: _replace(df, [name], lambda c: F.substring(c, 1, length))


def rename_in_order(names: list[str]) -> Transform:
    """Columns renamed by position; the number of names must be right."""

    def rename(df: DataFrame) -> DataFrame:
        if len(names) != len(df.columns):
            raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
        return df.toDF(*names)

    return rename


def fill_nulls(values: Mapping[str, object]) -> Transform:
    return lambda df: df.fillna(dict(values))


def cast_to_schema(schema, date_formats: Mapping[str, str] | None = None) -> Transform:
    """Every text column cast to its declared type in one projection.

    Dates use ``date_formats``, else the plain ISO cast.
    """
    formats = date_formats or {}

    def change(df: DataFrame) -> DataFrame:
        present = [f for f in schema.fields if f.name in df.columns]
        return df.select(
            *[
                (
                    F.to_date(f.name, formats[f.name])
                    if f.name in formats
                    else F.col(f.name).cast(f.dataType)
                ).alias(f.name)
                for f in present
            ]
        )

    return change


def pipeline(df: DataFrame, *steps: Transform) -> DataFrame:
    """Steps applied in order."""
    for step in steps:
        df = step(df)
    return df

"""Declarative validation rules, first failing rule wins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.sources import fixed_values as fixed


@dataclass(frozen=True)
class Required:
    column: str

    @property
    def reason(self) -> str:
        return fixed.IS_NULL_TEXT.format(column=self.column)

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class HasParent:
    """The FK check left no marker in ``flag``."""

    column: str
    parent: str
    flag: str

    @property
    def reason(self) -> str:
        return fixed.NO_PARENT_TEXT.format(column=self.column, parent=self.parent)

    def fails(self) -> Column:
        return F.col(self.flag).isNull()


@dataclass(frozen=True)
class OneOf:
    """NULL passes: membership of NULL is unknown, and an unknown test never rejects."""

    column: str
    domain: tuple[str, ...]
    label: str | None = None

    @property
    def reason(self) -> str:
        return fixed.INVALID_TEXT.format(column=self.label or self.column)

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.domain)


@dataclass(frozen=True)
class Matches:
    """NULL passes."""

    column: str
    pattern: str

    @property
    def reason(self) -> str:
        return fixed.INVALID_TEXT.format(column=self.column)

    def fails(self) -> Column:
        return ~F.col(self.column).rlike(self.pattern)


@dataclass(frozen=True)
class Positive:
    """NULL passes."""

    column: str

    @property
    def reason(self) -> str:
        return fixed.NOT_POSITIVE_TEXT.format(column=self.column)

    def fails(self) -> Column:
        return F.col(self.column) <= 0


@dataclass(frozen=True)
class NotNegative:
    """NULL passes."""

    column: str

    @property
    def reason(self) -> str:
        return fixed.NEGATIVE_TEXT.format(column=self.column)

    def fails(self) -> Column:
        return F.col(self.column) < 0


@dataclass(frozen=True)
class NotBefore:
    """Day-grain interval test; a NULL end passes."""

    column: str
    start: str

    @property
    def reason(self) -> str:
        return fixed.NEGATIVE_INTERVAL_TEXT

    def fails(self) -> Column:
        return F.col(self.column) < F.col(self.start)


Rule = Required | HasParent | OneOf | Matches | Positive | NotNegative | NotBefore


def rejection_reason(rules: Sequence[Rule]) -> Column:
    """Text of the first failing rule, NULL when all pass."""
    return F.coalesce(*[F.when(rule.fails(), F.lit(rule.reason)) for rule in rules])


def any_later_than(day: Column, columns: Sequence[str], optional: Sequence[str] = ()) -> Column:
    """True when any column lies after ``day``.

    A NULL in ``columns`` leaves the answer unknown unless another column is late; a NULL in
    ``optional`` counts as not late.
    """
    tests = [F.col(name) > day for name in columns]
    tests += [F.coalesce(F.col(name) > day, F.lit(False)) for name in optional]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def grade(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_is_valid`` and ``_rejection_reason`` from one rule list."""
    graded = df.withColumn("_rejection_reason", rejection_reason(rules))
    names = [*df.columns, "_is_valid", "_rejection_reason"]
    return graded.withColumn("_is_valid", F.col("_rejection_reason").isNull()).select(*names)


def valid(graded: DataFrame) -> DataFrame:
    return graded.where(F.col("_is_valid"))


def rejected(graded: DataFrame) -> DataFrame:
    return graded.where(~F.col("_is_valid"))

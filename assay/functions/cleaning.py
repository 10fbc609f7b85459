"""Text and date cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    return F.trim(name)


def lowered(name: str) -> Column:
    return F.lower(F.trim(name))


def uppered(name: str) -> Column:
    return F.upper(F.trim(name))


def dated(name: str) -> Column:
    """Day-grain date; text that is no date becomes NULL instead of failing the job."""
    return F.try_to_date(name)

"""Row fingerprints and reproducible pseudo-random draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from assay.sources.fixed_values import HASH_SEPARATOR

DRAW_RANGE = 1 << 32


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns as text. NULLs are skipped and the separator is not escaped."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *columns), 256)


def draw(key: Column, purpose: str) -> Column:
    """A number in [0, 2^32) fixed by the key and the purpose.

    MD5 gives every engine and every retry the same draw, so a feed regenerated after a lost
    executor is the same feed.
    """
    digest = F.md5(F.concat(F.lit(f"{purpose}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def chance(key: Column, purpose: str, rate: float) -> Column:
    """True for about ``rate`` of all keys."""
    return draw(key, purpose) < F.lit(round(rate * DRAW_RANGE))


def pick_number(key: Column, purpose: str, low: int, high: int) -> Column:
    """Uniform integer in [low, high]."""
    return draw(key, purpose) % F.lit(high - low + 1) + F.lit(low)


def pick_one(key: Column, purpose: str, values: Sequence[str]) -> Column:
    """Uniform choice."""
    position = draw(key, purpose) % F.lit(len(values))
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def pick_weighted(
    key: Column, purpose: str, values: Sequence[str], weights: Sequence[float]
) -> Column:
    """Choice with the given weights; the last value takes the remainder."""
    number = draw(key, purpose)
    ceiling, branches = 0.0, []
    for value, weight in zip(values[:-1], weights[:-1]):
        ceiling += weight
        branches.append(F.when(number < F.lit(round(ceiling * DRAW_RANGE)), F.lit(value)))
    return F.coalesce(*branches, F.lit(values[-1]))

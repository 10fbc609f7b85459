"""Feed generation: keys, samples, fan-out and injected faults, all fixed by the row's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions.hashing import chance


def format_key(number: Column, key_format: tuple[str, int]) -> Column:
    """Prefix and zero-padded number; a number with more digits keeps them all."""
    prefix, digits = key_format
    text = number.cast("string")
    width = F.greatest(F.length(text), F.lit(digits))
    return F.concat(F.lit(prefix), F.lpad(text, width, F.lit("0")))


def key_number(key: Column) -> Column:
    """The number in a formatted key."""
    return F.regexp_extract(key, "([0-9]+)$", 1).cast("bigint")


def sample_keys(df: DataFrame, key: str, purpose: str, share: float) -> DataFrame:
    """Sample without replacement: each key is in or out by its own draw, with no sort."""
    return df.where(chance(F.col(key), purpose, share))


def fan_out(df: DataFrame, children: Column, position: str) -> DataFrame:
    """Repeat each row ``children`` times, numbered from 1."""
    return df.select("*", F.explode(F.sequence(F.lit(1), children.cast("int"))).alias(position))


def null_where(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def replace_where(condition: Column, replacement: Column, value: Column) -> Column:
    return F.when(condition, replacement).otherwise(value)


def flip_sign_where(condition: Column, value: Column) -> Column:
    return F.when(condition, -F.abs(value)).otherwise(value)


def shift(moment: Column, unit: str, amount: Column) -> Column:
    """``moment`` moved by whole ``days``, ``hours`` or ``mins``."""
    return moment + F.make_dt_interval(**{unit: amount.cast("int")})


def moment_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def with_copies(df: DataFrame, copied: Column) -> DataFrame:
    """Add an exact copy of the chosen rows, in the same scan."""
    copies = F.when(copied, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def with_versions(df: DataFrame, versions: Column, version: str) -> DataFrame:
    """Repeat each row once for every number in the array ``versions``."""
    return df.select("*", F.explode(versions).alias(version))

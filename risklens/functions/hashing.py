"""Deterministic pseudo-random numbers from a key: the same row always falls on the same side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def unit_hash(key: Column, salt: str) -> Column:
    """Integer in [0, 2^32) from the key and a salt."""
    text = F.concat(key.cast("string"), F.lit(f"|{salt}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def fold_of(key: Column, folds: int, salt: str = "fold") -> Column:
    return (unit_hash(key, salt) % folds).cast("int")


def in_sample(key: Column, share: float, salt: str = "holdout") -> Column:
    """True for about ``share`` of the keys."""
    return unit_hash(key, salt) < int(share * 2**32)

"""Train/test and fold assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.hashing import hash_bucket

TRAIN_PERCENT = 70


def in_training(key: str = "id", percent: int = TRAIN_PERCENT) -> Column:
    """A NULL key counts as an empty one, so every row is on one side."""
    return hash_bucket(F.coalesce(key, F.lit("")), 100) < percent


def fold_of(key: str = "id", folds: int = 3) -> Column:
    """Fold number from other bits than the split uses."""
    return hash_bucket(F.coalesce(key, F.lit("")), folds, block=1)


def hash_split(df: DataFrame, key: str = "id", percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the key's hash: the same rows however the data is partitioned."""
    chosen = in_training(key, percent)
    return df.filter(chosen), df.filter(~chosen)

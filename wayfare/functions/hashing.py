"""Row-stable pseudo-randomness from a key column.

Values depend on the key alone, so a retried task, another partitioning or
another engine gives the same answer; ``rand`` and ``randomSplit`` do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bits(key: Column | str, block: int = 0, salt: str = "") -> Column:
    """32 bits of the key's md5 as BIGINT; ``block`` 0..3 picks independent bits."""
    key = _col(key) if not salt else F.concat(_col(key), F.lit(salt))
    return F.conv(F.substring(F.md5(key), 1 + 8 * block, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column | str, buckets: int, block: int = 0, salt: str = "") -> Column:
    return (hash_bits(key, block, salt) % buckets).cast("int")


def hash_uniform(key: Column | str, block: int = 0, salt: str = "") -> Column:
    """Uniform DOUBLE in [0, 1)."""
    return hash_bits(key, block, salt).cast("double") / F.lit(4294967296.0)

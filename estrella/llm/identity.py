"""Short keys for values of any length that are proven to be distinct."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """``df`` with a 64-bit key ``name`` of some columns, under which no two different values of these columns share a key.

    NULL and empty text are different values. A second hash, independent of the key, shows whether two values met; then the key is
    made anew with another seed. Only hashes are shuffled, and equal rows are one before that. ``df`` is read
    twice, so it should be a stored table.
    """
    for seed in count():
        # the first number sets the state that the columns are hashed from
        tells = F.concat_ws(",", *[F.col(c).isNull().cast("string") for c in columns])
        key = F.xxhash64(F.lit(2 * seed), tells, *columns)
        check = F.xxhash64(F.lit(2 * seed + 1), tells, *columns)
        met = df.select(key.alias("key"), check.alias("check")).groupBy("key").agg(F.min("check").alias("low"), F.max("check").alias("high"))
        if met.filter("low < high").isEmpty():
            return df.withColumn(name, key)
    raise AssertionError

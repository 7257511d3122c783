"""A Bloom filter over 64-bit keys, so that a join need only shuffle the rows that may have a partner.

It has 16 bits a key, and MOST_BITS at most: what is broadcast never exceeds 16 MB. Beyond that it lets more rows through, and the
join that follows decides; results are the same.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27


def _places(key: Column, bits: int) -> list[Column]:
    """Four places of a key that is a hash already: parts of it and of its hash."""
    other = F.xxhash64(key)
    return [x.bitwiseAND(F.lit(bits - 1)) for x in (key, F.shiftrightunsigned(key, 32), other, F.shiftrightunsigned(other, 32))]


def maybe_in(rows: DataFrame, key: str, keys: DataFrame) -> Column:
    """Whether column `key` of `rows` may be among the first column of `keys` (a staged table). False is sure; null for null.
    The bits are set by a partial aggregate; the driver gets as many longs as the filter has words."""
    spark = rows.sparkSession
    one = keys.select(F.col(keys.columns[0]).alias("key")).where("key IS NOT NULL")
    bits = min(max(1 << int(16 * max(one.count(), 1) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    places = one.select(F.explode(F.array(*_places(F.col("key"), bits))).alias("place"))
    words = places.groupBy(F.shiftrightunsigned("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits"))
    table = words.toArrow()
    held = np.zeros(bits // 64, np.int64)
    held[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(held.tobytes())

    @F.pandas_udf("boolean")
    def test(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        words = np.frombuffer(shared.value, np.int64)
        hit = lambda x: (words[x >> 6] >> (x & 63)) & 1
        return pd.Series(reduce(np.bitwise_and, [hit(x.to_numpy()) for x in (a, b, c, d)]).astype(bool))

    found = test(*[F.coalesce(p, F.lit(0)) for p in _places(F.col(key), bits)])
    return F.when(F.col(key).isNotNull(), found)

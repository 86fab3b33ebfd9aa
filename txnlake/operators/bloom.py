"""Bloom filters as rows of 64-bit words, built and probed by DataFrame functions alone.

A filter of m bits is (part, word, bits) with the words that are not zero. Building it explodes each key into its places and merges them
with bit_or, which is aggregated before the shuffle; probing joins a key's places to the words. A filter has ten bits for each key, about
a hundredth of keys that are not there are taken for present, and none that is there is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, PLACES = 10, 7


def size(rows: int) -> int:
    """Bits of a filter for so many keys."""
    return max(64, -(-rows * BITS_PER_KEY // 64) * 64)


def _places(key: Column, bits: Column) -> Column:
    """The places of a key in a filter of so many bits."""
    a, b = (F.pmod(F.xxhash64(F.lit(seed), key), bits) for seed in (5, 6))
    return F.array_distinct(F.array(*[F.pmod(a + F.lit(i) * b, bits) for i in range(PLACES)]))


def built(keys: DataFrame, key: str, part: str, bits: str) -> DataFrame:
    """(part, word, bits): the filters of rows that name their part and the size of its filter. Null keys are in none."""
    each = keys.where(F.col(key).isNotNull()).select(F.col(part).alias("part"), F.explode(_places(F.col(key), F.col(bits))).alias("at"))
    word = F.shiftright("at", 6)
    bit = F.expr("shiftleft(1L, CAST(at % 64 AS INT))")
    return each.select("part", word.alias("word"), bit.alias("bit")).groupBy("part", "word").agg(F.bit_or("bit").alias("bits"))


def possible(keys: DataFrame, key: str, part: str, bits: str, filters: DataFrame) -> DataFrame:
    """(part, key) of the keys that their part may hold."""
    places = _places(F.col(key), F.col(bits))
    asked = keys.where(F.col(key).isNotNull()).select(F.col(part).alias("part"), F.col(key).alias("key"), F.size(places).alias("n"), F.explode(places).alias("at"))
    asked = asked.distinct().withColumn("word", F.shiftright("at", 6))
    found = asked.join(filters, ["part", "word"]).where(F.expr("bits & shiftleft(1L, CAST(at % 64 AS INT)) <> 0"))
    return found.groupBy("part", "key", "n").count().where("count = n").select("part", "key")

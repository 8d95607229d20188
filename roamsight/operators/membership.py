"""Dropping rows with foreign keys at the scan, where the list of keys is too long to broadcast.

A blocked Bloom filter: each key sets up to four bits of one 64-bit word, all of them chosen by its hash. The words are a
table, combined before the shuffle by a bitwise or, and few enough to broadcast whatever the number of keys. Rows whose
bits are not all set belong to no key. Other rows may be strangers; the join that follows decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLACE, _BITS = "_place", "_bits"
KEYS_A_WORD = 4


def _bits(key: Column) -> Column:
    mixed = F.xxhash64(F.lit(1), key)
    places = [F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(63).cast("int") for i in range(4)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def filter_words(expected: int, most: int) -> int:
    """One word per ``KEYS_A_WORD`` expected keys, but never more than ``most``."""
    return max(1, min(most, -(-expected // KEYS_A_WORD)))


def _place(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("bigint"))


def key_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """A filter of at most so many words; words without a bit are left out."""
    placed = keys.select(_place(F.col(key), words).alias(_PLACE), _bits(F.col(key)).alias(_BITS))
    return placed.groupBy(_PLACE).agg(F.bit_or(_BITS).alias(_BITS))


def perhaps_in(df: DataFrame, key: str, found: DataFrame, words: int) -> DataFrame:
    """Rows of df whose key may be one of the filter's. No row of such a key is lost; the columns stay as they are."""
    mine = _bits(df[key])
    met = (_place(df[key], words) == found[_PLACE]) & (found[_BITS].bitwiseAND(mine) == mine)
    return df.join(F.broadcast(found), met, "left_semi")

"""Seeded hash expressions: the same row gets the same draw on any cluster layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_SPACE = 2**32


def seeded_md5(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))


def draw32(row_id: Column, seed: int) -> Column:
    """Uniform integer in [0, 2^32) taken from the leading eight hex digits."""
    return F.conv(F.substring(seeded_md5(row_id, seed), 1, 8), 16, 10).cast("bigint")


# The constants of MurmurHash3 for 32 bits, and the seed of hashed features.
MIX_1, MIX_2 = 0xCC9E2D51, 0x1B873593
FINISH_1, FINISH_2 = 0x85EBCA6B, 0xC2B2AE35
FEATURE_SEED = 42
_32 = 0xFFFFFFFF


def _times(value: Column, factor: int) -> Column:
    """Product modulo 2^32 of a 32-bit value held in a long, without overflowing it."""
    high = (value * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF))
    return (value * F.lit(factor & 0xFFFF) + F.shiftleft(high, 16)).bitwiseAND(F.lit(_32))


def _shifted(value: Column, bits: int) -> Column:
    return value.bitwiseXOR(F.shiftrightunsigned(value, bits))


def with_murmur3(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the 32-bit MurmurHash3 of the UTF-8 bytes of a column of strings, as an int; NULL for NULL.

    ``F.hash`` agrees with it on whole words of four bytes, and treats a rest differently. So the hash
    of the whole words is taken back to the state before its finish (each step there can be
    undone), the rest is mixed in as the standard has it, and the finish is done again. Every step is a
    projection of its own, as it names its value more than once; Spark compiles them into one stage.
    """
    size, state, rest = f"_{name}_size", f"_{name}_state", f"_{name}_rest"
    data = F.encode(F.col(text), "UTF-8")
    whole = F.col(size) - F.col(size) % 4

    def byte(k: int) -> Column:
        return F.when(F.col(size) % 4 > k, F.conv(F.hex(F.substring(data, whole + 1 + k, F.lit(1))), 16, 10).cast("long")).otherwise(0)

    steps = [
        {size: F.octet_length(F.col(text)).cast("long")},
        {state: F.hash(F.substring(data, F.lit(1), whole.cast("int"))).cast("long").bitwiseAND(F.lit(_32)),
         rest: byte(0) + F.shiftleft(byte(1), 8) + F.shiftleft(byte(2), 16)},
        {state: _shifted(F.col(state), 16)},
        {state: _times(F.col(state), pow(FINISH_2, -1, 1 << 32))},
        {state: _shifted(F.col(state), 13).bitwiseXOR(F.shiftrightunsigned(state, 26))},
        {state: _times(F.col(state), pow(FINISH_1, -1, 1 << 32))},
        {state: _shifted(F.col(state), 16).bitwiseXOR(whole), rest: _times(F.col(rest), MIX_1)},
        {rest: F.shiftleft(F.col(rest), 15).bitwiseOR(F.shiftrightunsigned(rest, 17)).bitwiseAND(F.lit(_32))},
        {state: F.col(state).bitwiseXOR(_times(F.col(rest), MIX_2)).bitwiseXOR(F.col(size))},
        {state: _shifted(F.col(state), 16)},
        {state: _times(F.col(state), FINISH_1)},
        {state: _shifted(F.col(state), 13)},
        {state: _times(F.col(state), FINISH_2)},
        {state: _shifted(F.col(state), 16)},
    ]
    for step in steps:
        df = df.withColumns(step)
    signed = F.col(state) - F.when(F.col(state) >= 1 << 31, F.lit(1 << 32)).otherwise(0)
    return df.withColumn(name, signed.cast("int")).drop(size, state, rest)


def with_bucket(df: DataFrame, text: str, name: str, size: int) -> DataFrame:
    """Add the feature that the hashing trick gives a term: its hash modulo ``size``, never negative."""
    return with_murmur3(df, text, name).withColumn(name, F.pmod(F.col(name), F.lit(size)))

"""Bit filters of key sets, as plain expressions: what surely isn't in a set is dropped where it is read, before anything is moved."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter at most (256 KB in the plan), and bits for each key at which it is worth having.
MOST_BITS, WORTH = 1 << 21, 4


def bits_for(n: int) -> int:
    """A power of two: 16 bits a key, if that many may be had."""
    return min(MOST_BITS, max(1 << 10, 1 << (16 * n - 1).bit_length()))


def places(key: Column, bits: int) -> list[Column]:
    """Two places of a key, by the halves of one hash."""
    h = F.xxhash64(key)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def membership(keys: DataFrame, key: str) -> Callable[[Column], Column] | None:
    """A test that holds for every key of the set, null excepted, and for few others. None for sets so large that most would pass.

    keys is read twice, so it should be cut or cheap. The driver gets the filter's words, 32,768 at most."""
    n = keys.count()
    bits = bits_for(n)
    if n * WORTH > bits:
        return None
    each = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*places(F.col(key), bits))).alias("p"))
    words = [0] * (bits >> 6)
    one_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    for r in each.select(F.shiftright("p", 6).cast("int").alias("w"), one_bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        words[r[0]] = r[1]
    held = F.from_json(F.lit(json.dumps(words)), "array<bigint>")  # folded into a constant

    def test(x: Column) -> Column:
        def is_set(p: Column) -> Column:
            word = F.get(held, F.shiftright(p, 6).cast("int"))
            return F.call_function("shiftright", word, p.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

        a, b = places(x, bits)
        return is_set(a) & is_set(b)

    return test

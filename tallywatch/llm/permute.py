"""Keyed pseudorandom permutations of 0 .. n-1 as column expressions (Luby and Rackoff 1988; Black and Rogaway 2002)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywatch.llm.words import let

ROUNDS = 6
#: Further steps of a walk. Fewer than sqrt(n) values lie outside, so up to n = 256 no
#: walk can be longer, and above that one is with a probability below 16 ** -17.
WALKS = 16


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def feistel(x: Column, n: Column, *key: Column) -> Column:
    """Where the permutation of ``n`` values named by ``key`` puts ``x``.

    The values are pairs (left, right) from a grid of just over ``n`` cells. Each round
    adds a keyed hash of one half to the other. A value that leaves 0 .. n-1 is put
    through again until it comes back, which keeps the map one to one. Null in, null
    out; ``x`` outside 0 .. n-1 has no defined result.
    """
    side = F.ceil(F.sqrt(n.cast("double"))).cast("long")

    def permuted(a: Column) -> Column:
        b = _div(n + a - 1, a)

        def one_round(i: int):
            def mixed(h: Column) -> Column:
                left, right = h["l"], h["r"]
                if i % 2 == 0:
                    left = F.pmod(left + F.pmod(F.xxhash64(*key, F.lit(i), right), a), a)
                else:
                    right = F.pmod(right + F.pmod(F.xxhash64(*key, F.lit(i), left), b), b)
                return F.struct(left.alias("l"), right.alias("r"))

            return mixed

        def rounds(value: Column) -> Column:
            halves = F.struct(_div(value, b).alias("l"), F.pmod(value, b).alias("r"))
            for i in range(ROUNDS):
                halves = let(halves, one_round(i))
            return let(halves, lambda h: h["l"] * b + h["r"])

        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(WALKS)), rounds(x),
            lambda value, _: F.when(value < n, value).otherwise(rounds(value)))
        return let(walked, lambda v: F.when(v < n, v).otherwise(
            F.raise_error(F.lit("a permutation walk did not end")).cast("long")))

    return let(side, permuted)

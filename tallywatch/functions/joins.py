"""Joins whose broadcast side has a checked size, and joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 32
HOT_SHARE = 1000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup(facts: DataFrame, key: str, table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join of a keyed table, unique on ``key``.

    A table within ``max_rows`` is broadcast. A larger one is repeated once per
    salt and joined on (key, salt), so that one frequent key, or null, is spread
    over many tasks.
    """
    if is_small(table, max_rows):
        return facts.join(F.broadcast(table), key, "left")
    salted = facts.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")


def join_frequent_apart(facts: DataFrame, table: DataFrame, on: list[str], weight: str, total: int,
                        max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of ``facts`` with a table holding every key once and its row count.

    A table within ``max_rows`` is broadcast. Of a larger one, the keys with at least
    1/1000 of all ``total`` rows are broadcast, of which there are at most 1000 per
    value of the other key columns; all other keys are rare enough for a shuffle
    join. Every fact row matches exactly one of the two. ``facts`` is then read twice.
    """
    if is_small(table, max_rows):
        return facts.join(F.broadcast(table.drop(weight)), on)
    frequent = F.col(weight) * HOT_SHARE >= F.lit(total)
    hot = table.where(frequent).drop(weight)
    cold = table.where(~frequent).drop(weight)
    marked = facts.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), on, "left")
    payload = [c for c in hot.columns if c not in on]
    hot_rows = marked.where(F.col("_hot")).drop("_hot")
    cold_rows = marked.where(F.col("_hot").isNull()).drop("_hot", *payload).join(cold, on)
    return hot_rows.unionByName(cold_rows)

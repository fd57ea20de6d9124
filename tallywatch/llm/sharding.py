"""Shards of bounded size by extendible hashing (Fagin et al. 1979).

A document's id is hashed to 60 bits. A bucket is a prefix of these bits; it holds the
documents whose hash begins with it. Starting from the empty prefix, a bucket whose
documents exceed the byte limit is split on one more bit, the others stay. The
directory lists the buckets that remain; a document finds its shard by its prefix.

All depths of one round are decided together: bytes are summed per prefix at a depth
somewhat below the expected one, and from there for every shorter prefix. A further
round, of four more bits, looks only at prefixes that were still too large. Sums are
combined on the map side, and the directory is a table, not a driver-side object.

Two cases no split can help: a document larger than the limit gets a shard of its own;
documents that share all 60 bits, that is one id, are cut into overflow pages by running
totals. Every shard but that of a single larger document is within the limit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.joins import is_small
from tallywatch.llm.mixing import running_total
from tallywatch.sources.scratch import materialise

LIMIT_BYTES = 16 * 1024 * 1024
BITS = 60
FINER = 3
STEP = 4
PAGE_ROWS = 20_000


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text; null counts as empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def prefix(value: Column, depth: int | Column) -> Column:
    """The first ``depth`` bits of a hash."""
    return F.call_function("shiftright", value, (F.lit(BITS) - depth).cast("int"))


@dataclass(frozen=True)
class Directory:
    """``rounds``: for each round its finest depth and (fine, depth, bytes), the bucket of
    every fine prefix that has one; ``full``: hashes whose documents exceed the limit alone."""

    rounds: list[tuple[int, DataFrame]]
    full: DataFrame
    limit: int

    def buckets(self) -> DataFrame:
        """(shard, depth, bytes) of every bucket but the overflow pages and single large documents."""
        parts = [
            leaves.select(_name(F.call_function("shiftright", "fine", (F.lit(g) - F.col("depth")).cast("int")),
                                F.col("depth")).alias("shard"), "depth", "bytes").distinct()
            for g, leaves in self.rounds
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def _name(bits: Column, depth: Column) -> Column:
    """A bucket's name: its bits, after a ``b`` so that the empty prefix has a name too."""
    return F.concat(F.lit("b"), F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(bits), depth.cast("int"), "0")))


def build_directory(hashed: DataFrame, limit: int = LIMIT_BYTES) -> Directory:
    """The directory of (hash, bytes); documents above the limit are left out."""
    sums = materialise(hashed.where(F.col("bytes") <= limit).groupBy("hash").agg(F.sum("bytes").alias("bytes")), "hashes")
    total = sums.agg(F.sum("bytes")).first()[0] or 0
    reach = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    rounds, least, left = [], 0, sums
    while True:
        depths = F.explode(F.sequence(F.lit(least), F.lit(reach))).alias("depth")
        # One row per fine prefix first, then one for each of its shorter prefixes.
        fine = materialise(left.groupBy(prefix(F.col("hash"), reach).alias("fine")).agg(
            F.sum("bytes").alias("bytes")), "fine-prefixes")
        shorter = F.call_function("shiftright", "fine", (F.lit(reach) - F.col("depth")).cast("int"))
        sizes = fine.select("fine", "bytes", depths).groupBy("depth", shorter.alias("node")).agg(F.sum("bytes").alias("bytes"))
        fitting = sizes.where(F.col("bytes") <= limit)
        found = fine.select("fine", depths).withColumn("node", shorter).join(fitting, ["depth", "node"])
        # Of the prefixes that fit, the shortest is the bucket.
        leaves = found.groupBy("fine").agg(F.min(F.struct("depth", "bytes")).alias("leaf")).select("fine", "leaf.*")
        rounds.append((reach, materialise(leaves, "directory")))
        over = fine.where(F.col("bytes") > limit).select("fine")
        if reach == BITS or over.isEmpty():
            return Directory(rounds, materialise(over.select(F.col("fine").alias("hash")), "full-hashes"), limit)
        again = left.withColumn("fine", prefix(F.col("hash"), reach)).join(over, "fine", "left_semi").drop("fine")
        left = materialise(again, "to-split")
        least, reach = reach + 1, min(BITS, reach + STEP)


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8 bytes of the text, 0 for null), ``shard``, ``depth`` (bits of
    its bucket) and ``shard_bytes``. Columns of these names are replaced.

    Rows with one id, null included, share a bucket unless it overflows. The pages of an
    overflow, and the shard of a document above the limit, are named after the full hash
    and a page or row number; their depth is 60.
    Empty texts weigh nothing. An empty table gives no rows.
    """
    added = ["n_bytes", "shard", "depth", "shard_bytes"]
    columns = [c for c in docs.columns if c not in added]
    # The rows travel as one column, so that no name of theirs can clash.
    hashed = docs.select(F.struct(*columns).alias("doc"), text_bytes(F.col(text_col)).alias("n_bytes"),
                         id_hash(F.col(id_col)).alias("_hash"))
    narrow = materialise(hashed.select(F.col("_hash").alias("hash"), F.col("n_bytes").alias("bytes")), "sizes")
    directory = build_directory(narrow, limit)
    large = not narrow.where(F.col("bytes") > limit).isEmpty()
    full = not directory.full.isEmpty()

    rest = hashed.where(F.col("n_bytes") <= limit) if large else hashed
    for i, (depth, leaves) in enumerate(directory.rounds):
        entry = leaves.select(F.col("fine").alias(f"_fine{i}"), F.col("depth").alias(f"_depth{i}"), F.col("bytes").alias(f"_bytes{i}"))
        entry = F.broadcast(entry) if is_small(entry) else entry
        rest = rest.join(entry, prefix(F.col("_hash"), depth) == F.col(f"_fine{i}"), "left")
    found = [f"_depth{i}" for i in range(len(directory.rounds))]
    depth = F.coalesce(*found)
    size = F.coalesce(*[f"_bytes{i}" for i in range(len(directory.rounds))])
    bucketed = rest.where(depth.isNotNull()).select(
        "doc", "n_bytes", _name(prefix(F.col("_hash"), depth), depth).alias("shard"), depth.alias("depth"),
        size.alias("shard_bytes"))
    apart = [hashed.where(F.col("n_bytes") > limit)] if large else []
    apart += [rest.where(depth.isNull()).select("doc", "n_bytes", "_hash")] if full else []
    for rows in apart:
        bucketed = bucketed.unionByName(_overflow(rows, limit))
    return bucketed.select("doc.*", *added)


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Pages of at most ``limit`` bytes for rows that share a whole hash; a larger row has its own.

    Rows of up to half the limit go by running totals in steps of half the limit, so a
    page ends less than one such row above half. Larger rows have a page each.
    """
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "overflow")
    half = limit // 2
    parts = -(-rows.count() // PAGE_ROWS)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)))
    step = F.when(F.col("n_bytes") > half, F.lit(0)).otherwise(F.col("n_bytes")).cast("long")
    placed = running_total(rows.withColumn("_step", step), "_hash", "_part", ["_row"], "_step", "_start")
    page = F.when(F.col("n_bytes") > half, F.concat(F.lit("r"), F.col("_row").cast("string"))).otherwise(
        F.concat(F.lit("p"), F.floor(F.col("_start") / F.lit(max(1, half))).cast("string")))
    placed = materialise(placed.withColumn("shard", F.concat(F.lit("h"), F.lower(F.hex("_hash")), F.lit("-"), page)), "pages")
    sizes = placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return placed.join(sizes, "shard").select("doc", "n_bytes", "shard", F.lit(BITS).alias("depth"), "shard_bytes")


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, each written by one task; a shard is at most the limit, a task a few shards."""
    assigned.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def shards_sql(limit: int = LIMIT_BYTES, table: str = "documents") -> str:
    """The same shards in DuckDB, for documents below the limit and buckets of up to 30 bits."""
    return f"""
WITH sized AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM {table}
),
depths AS (SELECT unnest(range(0, 31)) AS depth),
nodes AS (
  SELECT depth, h >> CAST(60 - depth AS INTEGER) AS node, sum(n_bytes) AS total
  FROM sized, depths GROUP BY 1, 2 HAVING sum(n_bytes) <= {limit}
),
placed AS (
  SELECT sized.doc_id, sized.n_bytes, sized.h, nodes.depth, nodes.node, nodes.total,
         row_number() OVER (PARTITION BY sized.h, sized.doc_id ORDER BY nodes.depth) AS place
  FROM sized, nodes WHERE nodes.node = sized.h >> CAST(60 - nodes.depth AS INTEGER)
)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, CAST(total AS BIGINT) AS shard_bytes,
       'b' || CASE WHEN depth = 0 THEN '' ELSE lpad(bin(node), CAST(depth AS INTEGER), '0') END AS shard
FROM placed WHERE place = 1
"""

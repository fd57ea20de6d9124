"""Mixing sources to target weights, block by block.

Every source's documents, in a pseudorandom order, form one stream of words that is cut
into blocks of ``block`` words. The mix is a sequence of slots, ``shard_slots`` to an
output shard. Each slot draws its source, so that a shard's source counts are a
multinomial draw. A source's j-th slot takes the block that a keyed permutation of the
source's blocks puts at j, the next permutation after every full pass, and slots and
blocks are joined on (source, block).

Draws alone miss a source's target by about the square root of its slots. Draws beyond
a source's number of slots are therefore handed, in slot order, to the sources that
drew too few. So every source fills exactly its share of slots, and none passes through
its blocks more than ``cap`` times. Nothing here depends on how rows are partitioned.

Only column expressions are used. Running totals are taken in two steps, inside parts of
bounded size and over the totals of the parts, so that no source needs one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.joins import is_small
from tallywatch.llm.permute import feistel
from tallywatch.llm.words import GAP, let
from tallywatch.sources.scratch import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK = 64
SHARD_SLOTS = 1024
PART_ROWS = 4_000
PART_SHARDS = 4096
CELLS = 4_096
SEED = 7


@dataclass(frozen=True)
class Mix:
    """``sizes``: one row per document with its place in its source's stream; ``sources``:
    size, target, blocks and slots of each source; ``slots``: the mix itself, one row per
    slot with shard, source rank, pass and block."""

    sizes: DataFrame
    sources: DataFrame
    slots: DataFrame
    block: int


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, GAP))).cast("long")


def running_total(df: DataFrame, group: str, part: str, order: list[str], value: str, into: str) -> DataFrame:
    """Add the sum of ``value`` over the group's earlier rows, by (part, order)."""
    totals = df.groupBy(group, part).agg(F.sum(value).alias("_total"))
    across = Window.partitionBy(group).orderBy(part)
    before = totals.select(group, part, (F.sum("_total").over(across) - F.col("_total")).alias("_before"))
    inside = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = df.withColumn("_upto", F.sum(value).over(inside) - F.col(value))
    return here.join(before, [group, part]).withColumn(into, F.col("_before") + F.col("_upto")).drop("_before", "_upto")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """(source, rank, source_size, weight, target) from (source, size).

    Sources in order of code points, null last, take the weights in turn. They divide
    ``share`` of all words by weight; a target that would exceed ``cap`` times its
    source stops there and the excess is divided again. The level at which that ends is
    found in one pass over the sources in the order in which they reach their caps.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    # One row per source from here on.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    table = table.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    limit = F.lit(float(cap)) * F.col("source_size")
    by_limit = Window.orderBy(limit / F.col("weight"), "rank")
    everything = Window.partitionBy()
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    left = budget - F.coalesce(F.sum(limit).over(earlier), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    level = left / open_weight
    table = table.withColumn("level", F.when(level <= limit / F.col("weight"), level))
    # The first level that fits; those after it count sources as capped that are not, and are lower.
    table = table.withColumn("level", F.max("level").over(everything))
    target = F.least(limit, F.coalesce(F.col("level") * F.col("weight"), limit))
    return table.select("source", "rank", "docs", "source_size", "weight", target.alias("target"))


def by_interval(df: DataFrame, value: str, total: int, intervals: DataFrame, small: bool) -> DataFrame:
    """Join each row to the interval [lo, hi) of 0 .. total-1 that holds its value.

    Intervals are cut at a fixed number of cells, so this is a join on the cell: at most
    ``CELLS`` rows more than there are intervals.
    """
    cells = min(CELLS, max(1, total))
    cell = lambda x: F.floor(x.cast("double") / F.lit(float(total)) * F.lit(float(cells)))
    cut = intervals.where("hi > lo").withColumn("_cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))
    here = df.withColumn("_cell", cell(F.col(value)))
    cut = F.broadcast(cut) if small else cut
    found = (here["_cell"] == cut["_cell"]) & (here[value] >= cut["lo"]) & (here[value] < cut["hi"])
    return here.join(cut, found).drop("_cell")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, block: int = BLOCK,
        shard_slots: int = SHARD_SLOTS, seed: int = SEED, part_rows: int = PART_ROWS) -> Mix:
    """Plan the mix of ``docs``; see the module's text.

    Null and empty texts have size 0 and are never drawn. A null source is a source.
    Null ids and repeated rows are documents like others; equal rows may change places,
    which changes no result. Other columns are not read. An empty table gives an empty mix.
    """
    spark: SparkSession = docs.sparkSession
    place = F.xxhash64(F.lit(seed), F.col(id_col))
    sizes = materialise(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        place.alias("place"), F.xxhash64(*docs.columns).alias("row_hash")), "sizes")
    sources = source_targets(sizes, weights, share, cap)
    blocks = F.ceil(F.col("source_size") / block)
    # A short last block makes the mean block shorter than `block`.
    wanted = F.round(F.col("target") / F.col("source_size") * blocks)
    sources = sources.withColumn("blocks", blocks).withColumn(
        "slots", F.when(F.col("source_size") > 0, F.least(wanted, F.lit(cap) * blocks)).otherwise(0).cast("long"))
    ends = F.sum("slots").over(Window.orderBy("rank"))
    sources = materialise(
        sources.withColumn("hi", ends).withColumn("lo", F.col("hi") - F.col("slots")), "sources")
    n_slots, most_docs = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.max("docs")).first()
    few = is_small(sources)

    # The streams: documents in hashed order, cut into parts of bounded size by that hash.
    parts = -(-(most_docs or 1) // part_rows)
    part = F.floor(F.col("place").cast("double") / F.lit(2.0**64) * parts)
    narrow = sources.select("source", "rank", "source_size", "target", F.col("blocks").alias("n_blocks"))
    narrow = F.broadcast(narrow) if few else narrow
    placed = sizes.withColumn("part", part).join(narrow, sizes["source"].eqNullSafe(narrow["source"])).drop(narrow["source"])
    streams = materialise(running_total(placed, "rank", "part", ["place", "id", "row_hash"], "size", "start"), "streams")

    # The draws.
    slots = spark.range(0, n_slots).select(
        F.col("id").alias("slot"), F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), F.col("id")), F.lit(max(1, n_slots))).alias("u"))
    intervals = sources.select("rank", "lo", "hi", F.col("slots").alias("quota"), F.col("blocks").alias("n_blocks"))
    drawn = by_interval(slots, "u", n_slots, intervals, few).drop("u", "lo", "hi")
    numbered = materialise(_number(drawn, "rank"), "draws")
    surplus = numbered.where("j >= quota").select("slot", "shard", F.lit(0).alias("all"))
    surplus = _number(surplus, "all").select("slot", "shard", F.col("j").alias("q"))
    # Sources that drew too few, and the numbers of the surplus draws that fall to each.
    counts = numbered.groupBy("rank").agg(F.count("*").alias("drawn"))
    short = sources.select("rank", F.col("slots").alias("quota"), F.col("blocks").alias("n_blocks")).join(
        counts, "rank", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    short = short.withColumn("lack", F.greatest(F.col("quota") - F.col("drawn"), F.lit(0)))
    short = short.withColumn("hi", F.sum("lack").over(Window.orderBy("rank"))).withColumn("lo", F.col("hi") - F.col("lack"))
    short = materialise(short, "lacking")
    lacking = short.agg(F.coalesce(F.sum("lack"), F.lit(0))).first()[0]
    moved = by_interval(surplus, "q", lacking, short, few).select(
        "slot", "shard", "rank", "n_blocks", (F.col("drawn") + F.col("q") - F.col("lo")).alias("j"))
    settled = numbered.where("j < quota").select("slot", "shard", "rank", "n_blocks", "j").unionByName(moved)
    turn = F.call_function("div", F.col("j"), F.col("n_blocks"))
    taken = feistel(F.pmod("j", "n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("rank"), F.col("pass"))
    slots = settled.withColumn("pass", turn).withColumn("block", taken).select("slot", "shard", "rank", "pass", "block")
    return Mix(streams, sources, materialise(slots, "slots"), block)


def _number(rows: DataFrame, group: str) -> DataFrame:
    """Add ``j``, the rows' numbers in each group in slot order: counts per shard, then places inside it."""
    counts = rows.groupBy(group, "shard").agg(F.count("*").alias("n")).withColumn(
        "shard_part", F.floor(F.col("shard") / PART_SHARDS))
    starts = running_total(counts, group, "shard_part", ["shard"], "n", "first").select(group, "shard", "first")
    inside = Window.partitionBy("shard", group).orderBy("slot")
    return rows.withColumn("_at", F.row_number().over(inside) - 1).join(starts, [group, "shard"]).withColumn(
        "j", F.col("first") + F.col("_at")).drop("first", "_at")


def _spans(plan: Mix) -> DataFrame:
    """One row per document and block it has words in: [from, to) of the document's words."""
    b = F.lit(plan.block)
    first, last = F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b)
    here = plan.sizes.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    return here.withColumn("from", F.greatest(F.col("block") * b - F.col("start"), F.lit(0))).withColumn(
        "to", F.least((F.col("block") + 1) * b - F.col("start"), F.col("size")))


def document_totals(plan: Mix) -> DataFrame:
    """(id, size, source_size, target, taken) for every document: the words the mix takes, repeats counted."""
    keys = ["id", "size", "source_size", "target", "rank", "start"]
    uses = plan.slots.groupBy("rank", "block").agg(F.count("*").alias("uses"))
    words = (F.col("to") - F.col("from")) * F.coalesce("uses", F.lit(0))
    some = _spans(plan).join(uses, ["rank", "block"], "left").groupBy(*keys).agg(F.sum(words).alias("taken"))
    none = plan.sizes.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return some.unionByName(none).select("id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    length_col: str = "n_chars", **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: for every pass through a source, one row
    for each document with words in it, holding those of its words that the pass takes.

    A document taken whole keeps its text exactly. Of others the taken runs of words follow one
    another, each word with the white space after it. ``length_col``, if there, is counted anew.
    """
    plan = mix(docs, id_col, text_col, source_col, **options)
    used = _spans(plan).join(plan.slots.select("rank", "pass", "block"), ["rank", "block"])
    runs = used.groupBy("id", "row_hash", "size", "rank", "start", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"), F.sum(F.col("to") - F.col("from")).alias("words"))
    # Equal rows are told apart by their number, which either side counts for itself.
    same = Window.partitionBy("id", "row_hash").orderBy("start")
    runs = runs.select("id", "row_hash", "size", "words", "runs", F.dense_rank().over(same).alias("copy"))
    # The rows travel as one column, so that no name of theirs can clash.
    row = F.xxhash64(*docs.columns)
    whole = docs.where(word_count(F.col(text_col)) > 0).select(F.struct(*docs.columns).alias("doc"), row.alias("row"))
    numbered = whole.withColumn("no", F.row_number().over(Window.partitionBy(F.col("doc")[id_col], "row").orderBy("row")))
    joined = numbered.join(runs, F.col("doc")[id_col].eqNullSafe(F.col("id")) & (F.col("row") == F.col("row_hash"))
                           & (F.col("no") == F.col("copy")))
    text = F.col("doc")[text_col]
    tidy = F.regexp_replace(text, r"^[\x20\x09-\x0D]+", "")
    part = F.col("words") < F.col("size")
    split = F.when(part, F.split(tidy, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"))
    cut = let(split, lambda words: F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(
        words, (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")))), ""))
    out = joined.select("doc", F.when(part, cut).otherwise(text).alias("text"))
    new = {text_col: F.col("text")}
    if length_col in docs.columns:
        new[length_col] = F.length("text").cast(docs.schema[length_col].dataType)
    return out.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])

"""Jaccard self-join of word-shingle sets, size-aware (Deng, Tao and Li 2018).

Two sets of sizes s and t link when their overlap is at least ``share / (100 + share)`` of
s + t, which for each pair of sizes is a fixed number c of common shingles.

* Small sets are joined by their subsets: each set is listed under all its subsets of c
  shingles, for every c that a partner of a possible size asks for. Sets that meet under a
  subset have the overlap; no further check is needed. Under one subset a set links with
  some other one exactly if it links with the smallest, so one link a set and subset does.
* Large sets scan inverted lists: rare shingles come first in every set, and a set enters
  the lists of as many of its first shingles as a linked pair must share one of. The place in
  both sets bounds the overlap, and pairs that pass are checked by their whole sets.

The size that divides the two is chosen by cost: the number of subsets of the sets up to it
against the length of the lists that those sets would scan, both counted over all rows.

Rows with equal sets are one set from the start. A list of very many sets that differ is not
turned into all its pairs. First every set in it is checked against one leader, the set with
the fewest shingles of its own; sets that link are put together. Only what is still apart
afterwards is paired, so links between sets already connected are neither looked for nor lost.

How rare a shingle is comes from counts in ``CELLS`` cells over all rows. It decides the
order of shingles, so the work, never the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.joins import join_frequent_apart
from tallywatch.llm.components import connected_components
from tallywatch.llm.words import byte_rows, extended, in_bitmap, pieces, set_bits, span_hashes, word_spans
from tallywatch.sources.scratch import materialise

WIDTH = 5
SHARE = 80
CELLS = 1 << 22
BLOCK = 1 << 16
BITS = 25
#: No larger set is listed by its subsets: at 0.8 one of this size has 10^9 of them.
SMALL = 48
ROUNDS = 1
PIECE = 4_000_000
#: Bytes of compressed texts whose sets are made and compared together.
ROOM = 500_000

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def least_overlap(sizes: int, share: int = SHARE) -> int:
    """The common shingles that two sets of together so many need to link."""
    return -(-share * sizes // (100 + share))


class _Sets:
    """The shingle sets of a batch of texts: ``items[bounds[i]:bounds[i + 1]]``, sorted, and a hash of each set."""

    def __init__(self, texts: pa.Array, width: int):
        raw, begin = byte_rows(texts)
        word = _WORD[raw]
        starts, ends = word_spans(word, begin)
        doc = np.searchsorted(begin, starts, side="right") - 1
        hashes = span_hashes(_LOWER[raw], starts, ends)
        words = np.bincount(doc, minlength=len(texts))
        first = np.cumsum(words) - words
        left = np.repeat(first + words, words) - np.arange(len(doc))
        at = np.flatnonzero((left >= width) | ((words[doc] < width) & (left == words[doc])))
        size = np.minimum(left[at], width)
        grams = size.astype(np.uint64)
        for k in range(width):
            more = size > k
            if more.all():
                grams = extended(grams, hashes[at + k])
            else:
                grams[more] = extended(grams[more], hashes[at[more] + k])
        owner = doc[at]
        ends = np.cumsum(np.bincount(owner, minlength=len(texts))).tolist()
        for lo, hi in zip([0, *ends], ends):
            grams[lo:hi].sort()
        fresh = np.ones(len(grams), dtype=bool)
        fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        self.items, self.owner = grams[fresh], owner[fresh]
        self.sizes = np.bincount(self.owner, minlength=len(texts))
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(extended(self.items, self.items), dtype=np.uint64)])
            self.key = extended(sums[self.bounds[1:]] - sums[self.bounds[:-1]], self.sizes.astype(np.uint64))

    def lists(self, rows: np.ndarray) -> pa.Array:
        """The sets of some rows as lists of longs."""
        n = self.sizes[rows]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.bounds[rows] - ends[:-1], n) + np.arange(ends[-1])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(self.items[at].view(np.int64)))


def _each(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, _Sets]]:
    for batch in batches:
        at = 0
        for texts in pieces(batch.column(column), PIECE):
            yield batch.slice(at, len(texts)), _Sets(texts, width)
            at += len(texts)


def _new(sets: _Sets, rows: np.ndarray, seen: set[int]) -> np.ndarray:
    """Those rows whose set this task has not met yet; copies of a text go out once a task."""
    _, first = np.unique(sets.key[rows], return_index=True)
    rows = rows[first]
    fresh = np.array([k not in seen for k in sets.key[rows].tolist()], dtype=bool)
    seen.update(sets.key[rows[fresh]].tolist())
    return rows[fresh]


def _cell(items: np.ndarray, cells: int) -> np.ndarray:
    return (items & np.uint64(cells - 1)).astype(np.int64)


def _scan(docs: DataFrame, id_type: T.DataType, width: int, small: int, cells: int) -> DataFrame:
    """One row (id, key, n, items of small sets) for each row of ``docs`` (id, text), and rows (block, uses).

    The latter hold a task's counts of the shingles in each cell, ``BLOCK`` cells to a row.
    """
    size = min(BLOCK, cells)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(cells, dtype=np.uint32)
        names = ["id", "key", "n", "items", "block", "uses"]
        kind = None
        for batch, sets in _each(batches, 1, width):
            uses += np.bincount(_cell(sets.items, cells), minlength=cells).astype(np.uint32)
            kind = batch.schema.field(0).type
            rows = np.flatnonzero((sets.sizes > 0) & (sets.sizes <= small))
            listed = np.zeros(len(sets.sizes), dtype=np.int64)
            listed[rows] = np.arange(len(rows))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sets.key.view(np.int64)), pa.array(sets.sizes, pa.int32()),
                sets.lists(rows).take(pa.array(listed, mask=(sets.sizes == 0) | (sets.sizes > small))),
                pa.nulls(len(sets.sizes), pa.int32()), pa.nulls(len(sets.sizes), pa.binary())], names)
        for block in range(0, cells if kind is not None else 0, size):
            part = uses[block:block + size]
            if part.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.list_(pa.int64())),
                    pa.array([block // size], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], names)

    types = [id_type, T.LongType(), T.IntegerType(), T.ArrayType(T.LongType()), T.IntegerType(), T.BinaryType()]
    schema = T.StructType([T.StructField(name, kind) for name, kind in zip(("id", "key", "n", "items", "block", "uses"), types)])
    return docs.mapInArrow(scan, schema)


def _cell_uses(blocks: DataFrame, cells: int) -> np.ndarray:
    """The counts of all tasks put together; one row for each block reaches the driver."""
    size = min(BLOCK, cells)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(part), dtype=np.uint32).astype(np.int64)
                sums[block] = sums[block] + counts if block in sums else counts
        for block, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counts.tobytes()])], ["block", "uses"])

    uses = np.zeros(cells, dtype=np.int64)
    for row in blocks.repartition("block").mapInArrow(total, "block int, uses binary").collect():
        uses[row["block"] * size:(row["block"] + 1) * size] = np.frombuffer(row["uses"], dtype=np.int64)
    # Beyond 65,535 uses the order no longer matters much; two bytes a cell go to the tasks.
    return np.minimum(uses, 65_535).astype(np.uint16)


def _rare_first(sets: _Sets, rows: np.ndarray, uses: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Where the ``n`` rarest items of each of some sets are, rare ones first, ties by the item itself."""
    rarity = uses[_cell(sets.items, len(uses))]
    out = [np.zeros(0, dtype=np.int64)]
    for lo, hi, k in zip(sets.bounds[rows].tolist(), sets.bounds[rows + 1].tolist(), n.tolist()):
        # Items are sorted already, so a stable sort leaves ties in their order.
        out.append(lo + np.argsort(rarity[lo:hi], kind="stable")[:k])
    return np.concatenate(out)


def subset_sizes(n: int, largest: int, share: int = SHARE) -> list[int]:
    """The overlaps that a set of ``n`` needs with sets of all sizes up to ``largest`` that it can link with."""
    out = {least_overlap(n + t, share) for t in range(1, largest + 1) if least_overlap(n + t, share) <= min(n, t)}
    return sorted(out)


def boundary(stats: dict[int, tuple[int, float]], share: int = SHARE) -> int:
    """The largest size joined by subsets, at the least cost.

    ``stats`` has, for each size, the number of sets and the entries that they would scan in lists.
    """
    sizes = sorted(stats)
    costs = {0: sum(scan for _, scan in stats.values())}
    for x in sizes:
        listed = sum(stats[n][0] * sum(comb(n, c) for c in subset_sizes(n, x, share)) for n in sizes if n <= x)
        costs[x] = listed + sum(stats[n][1] for n in sizes if n > x)
    return min(costs, key=lambda x: (costs[x], x))


def _chosen_boundary(small: DataFrame, uses: np.ndarray, share: int) -> int:
    """``boundary`` from the small sets of all rows; one row for each size reaches the driver."""
    shared = small.sparkSession.sparkContext.broadcast(uses)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = shared.value
        # A cell's count less that of an average one is what one shingle in it may have of its own.
        own = np.maximum(0, uses.astype(np.int64) - int(uses.mean())) + 1
        for batch in batches:
            n = batch.column(0).to_numpy()
            items = batch.column(1).flatten().to_numpy().view(np.uint64)
            lists = own[_cell(items, len(uses))]
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((lists, owner))
            place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            first = place <= (n - -(-share * n // 100))[owner]
            sums = np.bincount(owner, weights=lists[order] * first, minlength=len(n))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums)], ["n", "lists"])

    rows = small.select("n", "items").mapInArrow(scanned, "n int, lists double").groupBy("n").agg(
        F.count("*").alias("sets"), F.sum("lists").alias("lists")).collect()
    return boundary({r["n"]: (r["sets"], r["lists"]) for r in rows}, share)


def _subset_links(small: DataFrame, largest: int, share: int) -> DataFrame:
    """(a, b): links that connect the sets of up to ``largest`` shingles, from their common subsets."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            items = batch.column(2).flatten().to_numpy().view(np.uint64)
            begin = np.cumsum(n) - n
            for size in np.unique(n).tolist():
                mine = np.flatnonzero(n == size)
                table = items[begin[mine][:, None] + np.arange(size)]
                for c in subset_sizes(size, largest, share):
                    chosen = np.array(list(combinations(range(size), c)))
                    # So many sets at once that the table of their subsets stays small.
                    step = max(1, 2_000_000 // chosen.size)
                    for at in range(0, len(mine), step):
                        part = table[at:at + step]
                        hashes = np.full((len(part), len(chosen)), c, dtype=np.uint64)
                        for k in range(c):
                            hashes = extended(hashes, part[:, chosen[:, k]])
                        count = hashes.size
                        yield pa.RecordBatch.from_arrays([
                            pa.array(hashes.view(np.int64).ravel()), pa.array(np.full(count, c), pa.int32()),
                            pa.array(np.full(count, size), pa.int32()), pa.array(np.repeat(key[mine[at:at + step]], len(chosen)))],
                            ["subset", "c", "n", "key"])

    distinct = small.where(F.col("n") <= largest).groupBy("key").agg(F.first("n").alias("n"), F.first("items").alias("items"))
    members = materialise(distinct.mapInArrow(listed, "subset long, c int, n int, key long"), "subsets")
    shared = members.groupBy("subset", "c").agg(
        F.min(F.struct("n", "key")).alias("least"), F.count("*").alias("sets")).where("sets > 1")
    total = members.count()
    met = join_frequent_apart(members, materialise(shared, "shared-subsets"), ["subset", "c"], "sets", total)
    return met.where((F.col("key") != F.col("least.key")) & (F.col("c") * (100 + share) >= share * (F.col("n") + F.col("least.n")))).select(
        F.col("least.key").alias("a"), F.col("key").alias("b"))


def _entries(texts: DataFrame, uses: np.ndarray, largest: int, width: int, share: int) -> DataFrame:
    """(item, key, n, place): the inverted lists of the large sets, and of the small ones that a large set can link with."""
    shared = texts.sparkSession.sparkContext.broadcast(uses)
    least = least_partner(largest + 1, share)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _each(batches, 0, width):
            rows = _new(sets, np.flatnonzero(sets.sizes >= least), seen)
            n = sets.sizes[rows]
            # A large set may be the larger one of a pair, a small one is always the smaller.
            asked = np.where(n > largest, -(-share * n // 100), -(-2 * share * n // (100 + share)))
            first = n - asked + 1
            at = _rare_first(sets, rows, shared.value, first)
            place = np.arange(len(at)) - np.repeat(np.cumsum(first) - first, first)
            yield pa.RecordBatch.from_arrays([
                pa.array(sets.items[at].view(np.int64)), pa.array(np.repeat(sets.key[rows], first).view(np.int64)),
                pa.array(np.repeat(n, first), pa.int32()), pa.array(place, pa.int32())], ["item", "key", "n", "place"])

    return texts.mapInArrow(listed, "item long, key long, n int, place int")


def least_partner(n: int, share: int = SHARE) -> int:
    """The smallest set that one of ``n`` shingles can link with."""
    return -(-share * n // 100)


def _met(entries: DataFrame) -> DataFrame:
    """The entries of lists with two sets or more, each set once."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by item and set. One row is held back, because what follows decides about it.
        held, before = None, False
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            item, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(item):
                continue
            fresh = np.ones(len(item), dtype=bool)
            fresh[1:] = (item[1:] != item[:-1]) | (key[1:] != key[:-1])
            at = np.flatnonzero(fresh)
            same = np.zeros(len(at) + 1, dtype=bool)
            same[0] = before
            same[1:-1] = item[at[1:]] == item[at[:-1]]
            good = same[:-1] | same[1:]
            held, before = batch.slice(int(at[-1]), 1), bool(same[-2])
            out = at[:-1][good[:-1]]
            if len(out):
                yield batch.take(pa.array(out))
        if held is not None and before:
            yield held

    return entries.repartition("item").sortWithinPartitions("item", "key").mapInArrow(met, entries.schema)


def _whole_sets(texts: DataFrame, keys: DataFrame, width: int, bits: int) -> DataFrame:
    """(key, words) of the sets named by ``keys``, with its other columns. A bitmap of fixed size keeps most others from leaving the task.

    ``words`` is a compressed text with that set, which takes less room than hashes of its shingles do.
    """
    wanted = texts.sparkSession.sparkContext.broadcast(
        set_bits(np.zeros(1 << bits - 6, dtype=np.uint64), keys.select(F.col("key").alias("hash"))))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, sets in _each(batches, 0, width):
            rows = np.flatnonzero((sets.sizes > 0) & in_bitmap(wanted.value, sets.key))
            rows = _new(sets, rows, seen)
            words = [zlib.compress(text.encode().lower()) for text in batch.column(0).take(pa.array(rows)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sets.key[rows].view(np.int64)), pa.array(words, pa.binary())], ["key", "words"])

    found = texts.mapInArrow(listed, "key long, words binary").join(keys, "key")
    return found.dropDuplicates(["key"])


def _linked(both: DataFrame, width: int, share: int) -> DataFrame:
    """Those rows (a, b) of ``both`` (a, b, of_a, of_b) whose texts' sets link."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            room = sum(pc.binary_length(batch.column(k)).to_numpy().astype(np.int64) for k in (2, 3))
            runs = np.flatnonzero(np.diff(np.cumsum(room) // ROOM, prepend=-1))
            for lo, hi in zip(runs.tolist(), [*runs[1:].tolist(), len(room)]):
                part = batch.slice(lo, hi - lo)
                ends = np.concatenate([part.column(0).to_numpy(), part.column(1).to_numpy()])
                packed = pa.concat_arrays([part.column(2), part.column(3)])
                # A leader stands in many pairs, its set is made once.
                _, first, which = np.unique(ends, return_index=True, return_inverse=True)
                sets = _Sets(pa.array([zlib.decompress(words) for words in packed.take(pa.array(first)).to_pylist()], pa.large_binary()), width)
                items = [sets.items[i:j] for i, j in zip(sets.bounds[:-1].tolist(), sets.bounds[1:].tolist())]
                one, other = which[:hi - lo], which[hi - lo:]
                common = np.array([len(np.intersect1d(items[i], items[j], assume_unique=True)) for i, j in zip(one.tolist(), other.tolist())])
                good = common * 100 >= share * (sets.sizes[one] + sets.sizes[other] - common)
                yield part.select(["a", "b"]).filter(pa.array(good))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(link, "a long, b long")


def _checked(pairs: DataFrame, texts: DataFrame, width: int, share: int, bits: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets link."""
    pairs = materialise(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    # A set is sent only to the sides of the pairs on which it stands.
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("key"), F.lit(True).alias("first")), F.struct(F.col("b").alias("key"), F.lit(False).alias("first")))).alias("side"))
    keys = sides.groupBy("side.key").agg(F.bool_or("side.first").alias("as_a"), (~F.bool_and("side.first")).alias("as_b"))
    sets = materialise(_whole_sets(texts, materialise(keys, "pair-keys"), width, bits), "whole-sets")
    both = pairs.join(sets.where("as_b").select(F.col("key").alias("b"), F.col("words").alias("of_b")), "b").join(
        sets.where("as_a").select(F.col("key").alias("a"), F.col("words").alias("of_a")), "a")
    return _linked(both, width, share)


def _list_links(live: DataFrame, texts: DataFrame, links: DataFrame, largest: int, width: int, share: int, rounds: int, bits: int) -> DataFrame:
    """``links`` and further ones that connect all sets which the lists let link."""
    # The fewer of a set's first shingles are its own alone, the nearer it is to the middle of its group.
    first = F.col("n") - F.ceil(F.col("n") * F.when(F.col("n") > largest, share / 100).otherwise(2 * share / (100 + share)))
    # A key has as many entries as its text has first shingles, so one window holds part of one text.
    own = (first - F.count("*").over(Window.partitionBy("key"))).cast("int")
    live = materialise(live.withColumn("own", own), "central-entries")

    def labelled() -> DataFrame:
        roots = materialise(connected_components(links), "roots")
        return live.join(roots, F.col("key") == F.col("node"), "left").withColumn("label", F.coalesce("root", "key")).drop("node", "root")

    def may_link(one: str, other: str):
        overlap = F.least(F.col(f"{one}.n") - F.col(f"{one}.place"), F.col(f"{other}.n") - F.col(f"{other}.place"))
        sizes = F.col(f"{one}.n") + F.col(f"{other}.n")
        # Two small sets have met under their subsets.
        return (overlap * (100 + share) >= sizes * share) & (F.greatest(f"{one}.n", f"{other}.n") > largest)

    for k in range(rounds):
        entries = labelled() if k else live.withColumn("label", F.col("key"))
        # Keys are hashes, so the first round's ties need no draw, and its labels are the keys.
        draw = F.xxhash64(F.lit(k), "key").alias("draw") if k else F.lit(None).cast("long").alias("draw")
        entries = entries.select("item", F.struct("own", draw, "key", "n", "place", "label").alias("one"))
        leaders = entries.groupBy("item").agg(F.min("one").alias("lead"))
        pairs = entries.join(leaders, "item").where((F.col("one.label") != F.col("lead.label")) & may_link("one", "lead"))
        pairs = pairs.select(F.col("lead.key").alias("a"), F.col("one.key").alias("b")).distinct()
        links = materialise(links.unionByName(_checked(pairs, texts, width, share, bits)), "links")
    entries = materialise(labelled().select("item", F.struct("key", "n", "place", "label").alias("one")), "labelled-entries")
    # Lists whose sets are all connected have nothing left to look for.
    apart = entries.groupBy("item").agg(F.min("one.label").alias("low"), F.max("one.label").alias("high")).where("low < high").select("item")
    open_ = materialise(entries.join(apart, "item", "left_semi"), "open-entries")
    other = open_.select("item", F.col("one").alias("other"))
    pairs = open_.join(other, "item").where((F.col("one.label") < F.col("other.label")) & may_link("one", "other"))
    pairs = pairs.select(F.col("one.key").alias("a"), F.col("other.key").alias("b")).distinct()
    return materialise(links.unionByName(_checked(pairs, texts, width, share, bits)), "links")


def shingle_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, share: int = SHARE,
                    largest: int | None = None, rounds: int = ROUNDS, cells: int = CELLS, bits: int = BITS) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    A text's set holds its distinct sequences of ``width`` words (A-Z in lower case); a text of
    fewer words is one sequence. Sets link when ``100 * intersection >= share * union``.
    ``component_id`` is the smallest id that links reach, the row's own included. Null, empty
    and blank texts have no shingles and link with nothing: their component is their own id.
    Rows with a null id are kept; their component is the smallest id that is not null, or null
    if there is none. Repeated rows are all returned. Other columns are not read. An empty
    table gives no rows. ``largest`` sets the size up to which sets are joined by subsets
    (default: by cost). Words, shingles and sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType
    scanned = materialise(_scan(rows, id_type, width, SMALL, cells), "shingle-sets")
    uses = _cell_uses(scanned.where(F.col("block").isNotNull()).select("block", "uses"), cells)
    prints = scanned.where(F.col("block").isNull()).select("id", "key", F.col("n").cast("long").alias("n"))
    small = scanned.where(F.col("items").isNotNull()).select("key", "n", "items")
    if largest is None:
        largest = _chosen_boundary(small, uses, share)

    links = spark.createDataFrame([], "a long, b long")
    if largest:
        links = materialise(_subset_links(small, largest, share), "subset-links")
    texts = rows.select("text")
    live = materialise(_met(_entries(texts, uses, largest, width, share)), "met-entries")
    links = _list_links(live, texts, links, largest, width, share, rounds, bits)

    roots = connected_components(links)
    merged = prints.where("n > 0").groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    named = materialise(merged.join(roots, F.col("key") == F.col("node"), "left").select(
        "key", "least", "copies", F.coalesce("root", "key").alias("label")), "set-labels")
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = materialise(named.join(smallest, "label").select("key", "component_id", "copies"), "set-classes")
    total = prints.count()
    full = join_frequent_apart(prints.where("n > 0"), classes, ["key"], "copies", total)
    blank = prints.where("n = 0").withColumn("component_id", F.col("id"))
    return full.select("id", "n", "component_id").unionByName(blank.select("id", "n", "component_id")).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")

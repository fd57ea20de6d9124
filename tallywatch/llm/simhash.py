"""SimHash near duplicates (Charikar 2002), joined through binary tries.

A document's fingerprint has a 1 where more than half of its shingles' hashes have
one. Two fingerprints link if they differ in at most ``distance`` bits. Equal
fingerprints are merged before any join, so exact copies cost one row.

The join walks pairs of nodes of a binary trie over the fingerprints, adds up the bits
in which the two nodes' prefixes differ, and drops a pair once these exceed the
distance. The walk is spread over tasks thus: the 64 bits are cut into ``distance`` + 1
blocks, of which two linked fingerprints share at least one whole. Each fingerprint
therefore enters one trie for each block, turned so that the block comes first, and
only node pairs below an equal block are walked. A block value shared by more than
``unit_rows`` fingerprints is divided further into the node pairs some bits below it
that are still within the distance. Nothing is left out by either.

Inside a task the pairs found are merged into one link from each fingerprint to the
smallest of its group there; between tasks the links meet in ``connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.joins import HOT_SHARE, join_frequent_apart
from tallywatch.llm.components import connected_components
from tallywatch.llm.words import pieces
from tallywatch.sources.scratch import materialise

SHINGLE = 3
DISTANCE = 3
SEED = 42
UNIT_ROWS = 50_000
FRONTIER = 100_000
LEAF_PAIRS = 16


def text_fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text, for tests and single look-ups."""
    return int.from_bytes(_fingerprints([text.encode()], shingle, seed)[0].tobytes(), "big")


def _fingerprints(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """One row of eight bytes, highest first, for each UTF-8 text."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        # bytes.lower() changes A-Z alone and bytes.split() knows exactly the six white-space bytes.
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        width = min(shingle, len(words))
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]
        hashes += [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[width - 1:].tolist())]
        counts[i] = len(starts)
    out = np.zeros((len(texts), 8), dtype=np.uint8)
    if hashes:
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        full = np.flatnonzero(counts)
        first = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full, None], axis=1)
    return out


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint as a long. Null and empty texts have fingerprint 0."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [_fingerprints(pc.cast(p, pa.large_binary()).to_pylist(), shingle, seed)
                     for p in pieces(batch, 500_000)]
            rows = np.concatenate(parts) if parts else np.zeros((0, 8), np.uint8)
            yield pa.array(np.ascontiguousarray(rows).view(">i8").ravel().astype(np.int64))

    return of(text)


# ---- the walk inside a task ----


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Put each pair into one group; ``parent`` stays flat, and a root is its group's smallest member."""
    while len(a):
        a, b = parent[a], parent[b]
        differ = a != b
        a, b = a[differ], b[differ]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            higher = parent[parent]
            if (higher == parent).all():
                break
            parent[:] = higher


def _leaf_pairs(alo, ahi, blo, bhi) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with i from the first and j from the second range of each row."""
    na, nb = ahi - alo, bhi - blo
    row = np.repeat(np.arange(len(alo)), na * nb)
    within = np.arange(len(row)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
    return alo[row] + within // nb[row], blo[row] + within % nb[row]


def link_groups(values: np.ndarray, seeds: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """The smallest row linked, directly or not, with each row.

    ``seeds`` are node pairs (alo, ahi, blo, bhi, depth, differing bits): ranges of
    rows sorted by value inside each range, whose values share their first ``depth``
    bits. A pair of one node with itself has equal ranges.
    """
    parent = np.arange(len(values))
    ones: dict[int, np.ndarray] = {}
    stack = [seeds]
    while stack:
        pairs = stack.pop()
        if len(pairs) > FRONTIER:
            stack += [pairs[FRONTIER:], pairs[:FRONTIER]]
            continue
        alo, ahi, blo, bhi, depth, differ = pairs.T
        # Whole nodes: when the bits left cannot exceed the distance, all their rows link.
        whole = differ + (64 - depth) <= distance
        small = ~whole & ((ahi - alo) * (bhi - blo) <= LEAF_PAIRS)
        for i, j in ([_leaf_pairs(*(x[small] for x in (alo, ahi, blo, bhi)))] if small.any() else []):
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= distance)
            _merge(parent, i[near], j[near])
        if whole.any():
            w = pairs[whole]
            for lo, hi in ((w[:, 0], w[:, 1]), (w[:, 2], w[:, 3])):
                n = hi - lo
                rows = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                _merge(parent, np.repeat(w[:, 0], n), rows)
        pairs = pairs[~(whole | small)]
        if not len(pairs):
            continue
        children = []
        for d in np.unique(pairs[:, 4]):
            if d not in ones:
                bit = (values >> np.uint64(63 - d)) & np.uint64(1)
                ones[d] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
            alo, ahi, blo, bhi, _, differ = pairs[pairs[:, 4] == d].T
            acut = ahi - (ones[d][ahi] - ones[d][alo])
            bcut = bhi - (ones[d][bhi] - ones[d][blo])
            own = alo == blo
            deeper = np.full(len(alo), d + 1)
            for lo1, hi1, lo2, hi2, more, keep in (
                (alo, acut, blo, bcut, 0, True), (acut, ahi, bcut, bhi, 0, True),
                (alo, acut, bcut, bhi, 1, True), (acut, ahi, blo, bcut, 1, ~own),
            ):
                node = np.stack([lo1, hi1, lo2, hi2, deeper, differ + more], axis=1)
                children.append(node[keep & (lo1 < hi1) & (lo2 < hi2) & (differ + more <= distance)])
        stack.append(np.concatenate(children))
    return parent


def _turn(values: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each value's bits turned left."""
    by = by.astype(np.uint64)
    back = (np.uint64(64) - by) % np.uint64(64)
    return np.where(by == 0, values, (values << by) | (values >> back))


def _walk(rows: pd.DataFrame, distance: int) -> pd.DataFrame:
    """The links of whole units; a unit is a block value or a pair of nodes below one."""
    values = _turn(rows["fp"].to_numpy().astype(np.int64).view(np.uint64), rows["turn"].to_numpy())
    unit, side = rows["unit"].to_numpy(), rows["side"].to_numpy()
    order = np.lexsort((values, side, unit))
    values, unit, side = values[order], unit[order], side[order]
    depth, differ = rows["depth"].to_numpy()[order], rows["differ"].to_numpy()[order]
    fresh = np.concatenate([[True], (unit[1:] != unit[:-1]) | (side[1:] != side[:-1])])
    lo = np.flatnonzero(fresh)
    hi = np.append(lo[1:], len(values))
    first = np.flatnonzero(np.concatenate([[True], unit[lo][1:] != unit[lo][:-1]]))
    last = np.append(first[1:], len(lo)) - 1
    paired = first != last
    # A unit of two nodes with rows in only one of them has nothing to link.
    keep = paired | (differ[lo[first]] == 0)
    seeds = np.stack([lo[first], hi[first], lo[last], hi[last], depth[lo[first]], differ[lo[first]]], axis=1)
    parent = link_groups(values, seeds[keep].astype(np.int64), distance)
    fp = rows["fp"].to_numpy()[order]
    moved = parent != np.arange(len(parent))
    return pd.DataFrame({"a": fp[moved], "b": fp[parent[moved]]})


def linked_fingerprints(prints: DataFrame, distance: int = DISTANCE, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(a, b): links that connect the same distinct fingerprints ``fp`` as all links would."""
    blocks = distance + 1
    bits = 64 // blocks
    turns = prints.select("fp", F.explode(F.array(*[F.lit(i * bits) for i in range(blocks)])).alias("turn"))
    turned = F.expr("shiftleft(fp, turn) | CASE WHEN turn = 0 THEN 0L ELSE shiftrightunsigned(fp, 64 - turn) END")
    key = F.shiftrightunsigned("turned", 64 - bits)
    placed = turns.withColumn("turned", turned).withColumn("block", key)
    # Block values held by too many rows, with the number of further bits that divide
    # them; at most one for every unit_rows rows of the join.
    full = placed.groupBy("turn", "block").agg(F.count("*").alias("n")).where(F.col("n") > unit_rows)
    extra = F.least(F.lit(24), F.ceil(F.log2(F.col("n") / F.lit(float(unit_rows))))).cast("int")
    full = materialise(full.select("turn", "block", extra.alias("extra")), "full-blocks")
    placed = placed.join(full, ["turn", "block"], "left").withColumn("extra", F.coalesce("extra", F.lit(0)))
    # The node of a row, `extra` bits below its block, and the other nodes within the distance.
    node = F.expr(f"shiftrightunsigned(shiftleft(turned, {bits}), 64 - extra)")
    node = F.when(F.col("extra") == 0, F.lit(0).cast("long")).otherwise(node)
    flips = F.array(F.lit(0).cast("long"))
    one = F.expr("transform(sequence(0, extra - 1), i -> shiftleft(1L, i))")
    for _ in range(distance):
        flips = F.array_distinct(F.concat(flips, F.flatten(F.transform(
            flips, lambda f: F.transform(one, lambda b: f.bitwiseXOR(b))))))
    flips = F.when(F.col("extra") == 0, F.array(F.lit(0).cast("long"))).otherwise(flips)
    units = (
        placed.withColumn("node", node).withColumn("flip", F.explode(flips))
        .withColumn("other", F.col("node").bitwiseXOR(F.col("flip")))
        .select(
            "fp", "turn", F.lit(bits).alias("base"), "extra",
            F.bit_count("flip").cast("int").alias("differ"),
            (F.col("node") > F.col("other")).cast("int").alias("side"),
            F.xxhash64("turn", "block", F.least("node", "other"), F.greatest("node", "other")).alias("unit"),
            "block", F.least("node", "other").alias("n1"), F.greatest("node", "other").alias("n2"),
        )
        .withColumn("depth", F.col("base") + F.col("extra"))
    )
    keys = ["turn", "block", "n1", "n2"]
    dealt = units.repartition(*keys).sortWithinPartitions(*keys)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            if not len(frame):
                continue
            held.append(frame)
            size += len(frame)
            if size < unit_rows:
                continue
            rows = pd.concat(held, ignore_index=True)
            same = (rows[keys] == rows[keys].iloc[-1]).all(axis=1).to_numpy()
            begun = len(rows) - int(same[::-1].argmin()) if not same.all() else 0
            if begun:
                yield _walk(rows.iloc[:begun], distance)
            held = [rows.iloc[begun:]]
            size = len(held[0])
        if size:
            yield _walk(pd.concat(held, ignore_index=True), distance)

    return dealt.mapInPandas(walk, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, seed: int = SEED, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hexadecimal digits. ``component_id`` is the
    smallest id among the documents reachable through links, the document included.
    Null and empty texts have fingerprint zero and link like any others. Texts with
    fewer words than a shingle are one shingle. Rows with a null id are kept; their
    component is the smallest id that is not null, or null if there is none. Repeated
    rows are all returned. Other columns are not read. An empty table gives no rows.
    """
    prints = materialise(
        docs.select(F.col(id_col).alias(id_col), fingerprint(F.col(text_col), shingle, seed).alias("fp")),
        "fingerprints")
    labelled = _labelled(prints, F.min(id_col), distance, unit_rows)
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = labelled.join(smallest, "label").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _labelled(prints: DataFrame, least: Column, distance: int, unit_rows: int) -> DataFrame:
    """(fp, least, label): each distinct fingerprint, an aggregate of its rows, and the root of its group."""
    merged = materialise(prints.groupBy("fp").agg(least.alias("least")), "distinct-fingerprints")
    roots = connected_components(linked_fingerprints(merged, distance, unit_rows))
    # A group that a third of all documents belong to is still one row for each of its fingerprints.
    return merged.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("label"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE, seed: int = SEED, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with its columns.

    The row with the smallest id stays. A null id comes after all others, and of rows
    with one id those with a null text come last, the others in the order of a row hash.
    Ids do not tie rows together: rows of different groups all stay, whether their ids
    are null, equal or neither.
    """
    columns = [F.col(c) for c in docs.columns]
    # Maps have no hash of their own. A row is named by two hashes; rows whose texts are equal share a group anyway.
    hashed = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema]
    a = F.xxhash64(F.lit(1), F.col(text_col)).alias("a")
    b = F.xxhash64(*hashed, *[c.isNull() for c in columns]).alias("b")
    own = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(text_col).isNull().alias("no_text"), b, a)
    prints = materialise(docs.select(fingerprint(F.col(text_col), shingle, seed).alias("fp"), own.alias("own")), "fingerprints")
    labelled = _labelled(prints, F.min("own"), distance, unit_rows)
    chosen = materialise(labelled.groupBy("label").agg(F.min("least").alias("own")).select("own.a", "own.b"), "chosen-rows")
    repeated = materialise(
        prints.groupBy("own.a", "own.b").agg(F.count("*").alias("n")).where("n > 1"), "repeated-rows")
    rows = docs.select(F.struct(*columns).alias("row"), a, b)
    key = ["a", "b"]
    if repeated.isEmpty():
        return rows.join(chosen, key, "left_semi").select("row.*")
    # Rows that are repeated as a whole: the very frequent ones, chosen or not, stay out of the
    # shuffle join, and the chosen ones are reduced to one on the map side.
    total = prints.count()
    frequent = repeated.where(F.col("n") * HOT_SHARE >= F.lit(total))
    once = chosen.join(repeated, key, "left_anti")
    single = rows.join(F.broadcast(frequent), key, "left_anti").join(once, key, "left_semi")
    several = join_frequent_apart(rows, repeated.join(chosen, key, "left_semi"), key, "n", total)
    one = several.groupBy(*key).agg(F.first("row").alias("row"))
    return single.select("row.*").unionByName(one.select("row.*"))

"""Token ids in training order: fixed-length sequences, a keyed global shuffle, shards of fixed stride.

Every text becomes its tokens and an end mark, cut into sequences of ``length`` ids, the
last filled up with end marks. Sequences are numbered in the order in which they are read.
A keyed Feistel permutation with cycle-walking (``permute``) maps the numbers onto
slots: a bijection that needs no table, so any slot can be found from the key alone.
Sequences are range-partitioned by shard and written as one row per shard, whose payload
is its sequences one after the other. Slot ``s`` is at byte ``(s % per_shard) * stride``
of shard ``s // per_shard``, so a run resumes anywhere by arithmetic.

Tasks count their sequences while they tokenise; the totals of the partitions, one row
each, place every partition in the whole. The token rows move once, to their shards.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.functions.joins import is_small
from tallywatch.llm.permute import feistel
from tallywatch.llm.words import pieces
from tallywatch.sources.scratch import materialise, new_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed values of this public vocabulary: the pattern that cuts text before merging, and the free id for the end.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50_256
LENGTH = 256
PER_SHARD = 4_096
KEY = 20_240_229
PIECE = 16_000_000
STRIDE_BYTES = 2


@dataclass(frozen=True)
class Layout:
    """What a reader needs besides the shards."""

    length: int
    per_shard: int
    sequences: int
    key: int

    @property
    def stride(self) -> int:
        return self.length * STRIDE_BYTES

    def place(self, slot: int) -> tuple[int, int]:
        """(shard, byte offset) of a slot."""
        return slot // self.per_shard, slot % self.per_shard * self.stride


class Tokenizer:
    """A byte-level BPE vocabulary; equal stretches of a batch are encoded once.

    A blank between two characters that are no white space always begins a new stretch
    under the pattern, so a text without white space next to a blank is the sum of its
    stretches. Other texts are encoded whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken

        self.encoding = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.line = ranks[b"\n"]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts' tokens one after the other."""
        odd = pc.match_substring_regex(texts, r"[\s\p{Z}\x1c-\x1f] | [\s\p{Z}\x1c-\x1f]|\x85").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        split = pc.split_pattern(plain, " ")
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = split.flatten()
        first = np.concatenate([[0], np.cumsum(counts)])
        heads = np.zeros(len(flat), bool)
        heads[first[:-1][counts > 0]] = True
        # A stretch that does not begin its text carries the blank before it.
        coded = flat.dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        begun, at = np.unique(codes[heads], return_inverse=True)
        codes[heads] = len(names) + at
        bare = pc.match_substring_regex(names, r"^[^\s\p{Z}\x0b\x1c-\x1f\x85]+$").to_numpy(zero_copy_only=False)
        each, sizes, place = self._stretches(names, bare, begun)
        codes = place[codes]
        ids = each.take(pa.array(codes)).flatten().to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(sizes[codes], dtype=np.int64)])
        bounds = upto[first]
        if odd.any():
            own = [ids[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
            for i in np.flatnonzero(odd):
                own[i] = np.array(self.encoding.encode_ordinary(texts[int(i)].as_py()), np.uint16)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            ids = np.concatenate(own)
        return ids, bounds

    def _stretches(self, names: pa.Array, bare: np.ndarray, begun: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The ids of every name behind a blank, then of the names ``begun`` without one: lists of ids,
        their sizes, and where each stretch is in them. Names without white space go through
        in one call with a line break behind each, which no merge crosses."""
        encode = self.encoding.encode_ordinary
        plain = names.filter(pa.array(bare))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain.cast(pa.string())), "\n ")
        ids = np.array(encode(f" {joined[0].as_py()}\n") if len(plain) else [], np.uint16)
        ends = np.flatnonzero(ids == self.line)
        ids = np.delete(ids, ends)
        first = np.diff(np.concatenate([[-1], ends])) - 1
        others = [f" {x}" for x in names.filter(pa.array(~bare)).to_pylist()] + names.take(pa.array(begun)).to_pylist()
        pool, more = [], []
        for x in others:
            own = encode(x)
            more.append(len(own))
            pool += own
        sizes = np.concatenate([first, np.array(more, np.int64)]).astype(np.int64)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate([ids, np.array(pool, np.uint16)])))
        place = np.empty(len(names) + len(begun), np.int32)
        place[np.concatenate([np.flatnonzero(bare), np.flatnonzero(~bare), len(names) + np.arange(len(begun))])] = np.arange(len(place))
        return lists, sizes, place

    def decode(self, ids: np.ndarray) -> str:
        return self.encoding.decode_bytes([int(t) for t in ids]).decode("utf-8", errors="replace")


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def tokenised(rows: DataFrame, ranks: dict[bytes, int], length: int = LENGTH) -> DataFrame:
    """(id, n_tokens, part, before, n, sequences) from (id, text): the text's ``n`` sequences, binaries of
    two bytes an id, lowest byte first, and how many sequences its partition holds before them.

    Null and empty texts are one sequence of end marks. Ids beyond 65535 are not supported.
    """
    if max(ranks.values()) > 65_535:
        raise ValueError("the vocabulary needs more than two bytes an id")
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, done = Tokenizer(shared.value), 0
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(1), PIECE):
                ids, bounds = tokenizer.encode(texts)
                n = np.diff(bounds)
                per_text = n // length + 1
                first = np.cumsum(per_text) - per_text
                block = np.full(per_text.sum() * length, END, np.uint16)
                block[np.repeat(first * length, n) + np.arange(len(ids)) - np.repeat(bounds[:-1], n)] = ids
                cells = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(length * STRIDE_BYTES), len(block) // length, [None, pa.py_buffer(block.astype("<u2").tobytes())])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32()), cells.cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), batch.column(2).slice(at, len(texts)),
                     pa.array(done + first, pa.int64()), pa.array(per_text, pa.int64()), lists],
                    ["id", "n_tokens", "part", "before", "n", "sequences"])
                done += int(per_text.sum())
                at += len(texts)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        encode, f"id {kind}, n_tokens long, part int, before long, n long, sequences array<binary>")


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
            length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> tuple[DataFrame, Layout]:
    """One row per sequence, (id, place, n_tokens, slot, shard, sequence), and the layout.

    Sequences are numbered as their documents are read, so the same files read in the same
    partitions give the same order. Null ids and repeated rows have sequences of their own.
    Other columns are not read; an empty table gives no rows.
    """
    ranks = read_ranks(vocabulary)
    spark, path = docs.sparkSession, new_folder(docs.sparkSession, "tokens")
    rows = tokenised(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ranks, length)
    rows.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    # One row for each partition of the scan.
    totals = materialise(stored.groupBy("part").agg(F.sum("n").alias("total")), "token-counts")
    total = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    earlier = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("earlier"))
    layout = Layout(length, per_shard, total, key)
    joined = stored.join(F.broadcast(earlier) if is_small(totals) else earlier, "part")
    out = joined.select("id", "n_tokens", (F.col("earlier") + F.col("before")).alias("first"),
                        F.posexplode("sequences").alias("place", "sequence"))
    slot = feistel(F.col("first") + F.col("place"), F.lit(total).cast("long"), F.lit(key))
    out = out.withColumn("slot", slot).withColumn("shard", F.floor(F.col("slot") / per_shard))
    return out.select("id", "place", "n_tokens", "slot", "shard", "sequence"), layout


def shards(sequences: DataFrame, layout: Layout) -> DataFrame:
    """(shard, first_slot, n_sequences, payload): one row per shard, its sequences in slot order.

    Sequences are range-partitioned by slot, a number of partitions that follows the
    number of shards; a task holds one shard's payload at a time.
    """
    per, stride = layout.per_shard, layout.stride
    n_shards = max(1, -(-layout.sequences // per))
    slots = sequences.select("slot", "shard", "sequence").repartitionByRange(min(n_shards, 10_000), "shard")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[bytes] = []
        now = None
        row = lambda: pd.DataFrame({"shard": [now], "first_slot": [now * per], "n_sequences": [len(held)],
                                    "payload": [b"".join(held)]})
        for frame in frames:
            for shard, sequence in zip(frame["shard"], frame["sequence"]):
                if shard != now and held:
                    yield row()
                    held = []
                now = shard
                held.append(sequence)
        if held:
            yield row()

    return slots.sortWithinPartitions("slot").mapInPandas(pack, "shard long, first_slot long, n_sequences long, payload binary")


def write_shards(docs: DataFrame, path: str, **options) -> Layout:
    """Write the shards of ``docs`` below ``path`` in training order and return their layout."""
    sequences, layout = ordered(docs, **options)
    shards(sequences, layout).write.mode("overwrite").parquet(path)
    return layout


def read_slots(spark: SparkSession, path: str, layout: Layout, start: int, stop: int) -> DataFrame:
    """(slot, tokens) of the slots from ``start`` to before ``stop``: only the shards that hold them are read."""
    first, last = start // layout.per_shard, (stop - 1) // layout.per_shard
    rows = spark.read.parquet(path).where(F.col("shard").between(first, last))
    place = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_sequences") - 1)).alias("at")
    cut = F.substring("payload", (F.col("at") * layout.stride + 1).cast("int"), F.lit(layout.stride))
    return rows.select("first_slot", "payload", place).select((F.col("first_slot") + F.col("at")).alias("slot"), cut.alias("tokens")).where(
        (F.col("slot") >= start) & (F.col("slot") < stop))

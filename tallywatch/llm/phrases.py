"""Collocations of two to four words by dynamic itemset counting (Brin and others 1997).

The corpus is cut into shards that are scanned in a circle. Words are counted from the
first shard on. As soon as both parts of a longer phrase, all but its last and all but its
first word, have reached the threshold in what was scanned so far, the phrase is counted
from the next shard on, while shorter ones still go round. Every phrase is counted until
it has seen each shard once; no phrase with the threshold reached can be missed, because
its parts have reached it too. The scans end when nothing is being counted.

What has reached the threshold is a bitmap over 64-bit hashes of (lang, phrase), of a fixed
size (``BITS``), sent to every task; one bitmap for each of the last scans tells when a
phrase was activated, so that tasks emit it for one round only. A hash that shares its
bit with another one is counted or taken for frequent too early. That costs work and loses
nothing, because a last scan counts the phrases that the bitmap holds by their own text, and
only those counts are returned. Phrases that have reached the threshold are no longer
emitted, and counts of the others are dropped at the end of their round, so the table of
running counts, which Spark keeps merged by hash, holds only what is undecided.

Running counts go by the first bits of a phrase's hash, sorted and packed as blocks: one row
holds a task's counts of one part of all hashes whose rounds end with one step. Phrases that
share those bits are counted as one, so one of them may come early but none is missed.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.joins import join_frequent_apart, lookup
from tallywatch.llm.words import byte_rows, extended, hash64, in_bitmap, pieces, set_bits, span_hashes, word_spans
from tallywatch.sources.scratch import materialise, new_folder

LEAST = 30
LONGEST = 4
SHARDS = 3
BITS = 25
TOP = 2000
#: A phrase goes if a longer one around it is at least so frequent, in hundredths.
HELD = 80
SCALE = 2_000_000
#: Texts are handled in pieces of about so many bytes; hashes of several pieces are counted together, phrases kept with their text.
PIECE = 1_000_000
CHUNK = 1 << 21
KEPT = 1 << 20
#: Bits of a hash after those that name its part.
LOW = 32
NO_LANG = "und"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Tokens:
    """The words of a batch of texts: hashes with the language in them, pieces, and their bytes."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        raw, bounds = byte_rows(texts)
        kind, self.bytes = _KIND[raw], _LOWER[raw]
        word = kind == 0
        self.starts, self.ends = word_spans(word, bounds)
        self.doc = np.searchsorted(bounds, self.starts, side="right") - 1
        # Neither separators nor the end of a text lie between words of one piece.
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts] + self.doc if len(raw) else np.zeros(0, np.int64)
        coded = langs.dictionary_encode()
        self.lang_of = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.langs = coded.dictionary
        tags = hash64(*byte_rows(self.langs))
        hashes = span_hashes(self.bytes, self.starts, self.ends)
        self.hash = extended(tags[self.lang_of[self.doc]], hashes) if len(hashes) else hashes

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        """The phrases of ``length`` words from some words on, their words joined by one space."""
        starts, ends = self.starts[at], self.ends[at + length - 1]
        # In most places there is one blank between words already; the others are put together word by word.
        single = ends - starts == sum(self.ends[at + k] - self.starts[at + k] for k in range(length)) + length - 1
        starts, sizes = starts[single], (ends - starts)[single]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        data = self.bytes[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])]
        data[data == 0x09] = 0x20
        direct = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
        if single.all():
            return direct
        others = pa.array([b" ".join(self.bytes[self.starts[k]:self.ends[k]].tobytes() for k in range(i, i + length))
                           for i in at[~single].tolist()], pa.large_binary())
        order = np.empty(len(at), dtype=np.int64)
        order[single], order[~single] = np.arange(len(direct)), len(direct) + np.arange(len(others))
        return pa.concat_arrays([direct, others]).take(pa.array(order))


def _edges(ordered: np.ndarray) -> np.ndarray:
    """Where another value begins."""
    fresh = np.ones(len(ordered), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(fresh)


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, how often each occurs)."""
    ordered = np.sort(hashes)
    edges = _edges(ordered)
    return ordered[edges], np.diff(np.append(edges, len(ordered)))


class _Kept:
    """Phrases of several batches with their text and counts, told apart by their hashes, and the words of each language."""

    def __init__(self):
        self.known = np.zeros(0, dtype=np.uint64)
        self.lengths, self.langs, self.phrases = [], [], []
        self.hashes, self.n = [], []
        self.totals: Counter[str] = Counter()

    def count(self, tokens: _Tokens, frequent: np.ndarray, longest: int) -> None:
        fresh, known = [], np.sort(self.known)
        for length, at, hashes, _ in _levels(tokens, [frequent], longest):
            good = in_bitmap(frequent, hashes)
            at, hashes = at[good], hashes[good]
            order = np.argsort(hashes)
            edges = _edges(hashes[order])
            distinct, places = hashes[order[edges]], at[order[edges]]
            self.hashes.append(distinct)
            self.n.append(np.diff(np.append(edges, len(order))))
            if len(known):
                place = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
                new = known[place] != distinct
                distinct, places = distinct[new], places[new]
            fresh.append(distinct)
            self.langs.append(tokens.langs.take(pa.array(tokens.lang_of[tokens.doc[places]])))
            self.lengths.append(np.full(len(places), length))
            self.phrases.append(tokens.phrases(places, length))
        self.known = np.concatenate([self.known, *fresh])
        for lang, n in zip(tokens.langs.to_pylist(), np.bincount(tokens.lang_of[tokens.doc], minlength=len(tokens.langs)).tolist()):
            self.totals[lang] += n

    def blocks(self, part_bits: int) -> pa.RecordBatch:
        """(part, block): the phrases of each part of all hashes as one Arrow table; the first part has the languages' words too."""
        order = np.argsort(self.known)
        hashes, each = np.concatenate([np.zeros(0, np.uint64), *self.hashes]), np.concatenate([np.zeros(0, np.int64), *self.n])
        by_hash = np.argsort(hashes)
        n = np.add.reduceat(each[by_hash], _edges(hashes[by_hash])) if len(hashes) else each
        rows = pa.table({
            "lang": pa.concat_arrays([pa.array([], pa.string()), *self.langs]).take(pa.array(order)),
            "length": pa.array(np.concatenate([np.zeros(0, np.int64), *self.lengths])[order], pa.int32()),
            "phrase": pa.concat_arrays([pa.array([], pa.large_binary()), *self.phrases]).take(pa.array(order)),
            "n": pa.array(n, pa.int64())})
        part = (self.known[order] >> np.uint64(64 - part_bits)).astype(np.int32)
        bounds = np.append(_edges(part), len(part)) if len(part) else np.zeros(1, np.int64)
        tables = [(0, pa.table([list(self.totals), [0] * len(self.totals), [None] * len(self.totals), list(self.totals.values())], schema=rows.schema))]
        tables += [(int(part[lo]), rows.slice(lo, hi - lo)) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in tables], pa.int32()), pa.array([_as_bytes(table) for _, table in tables], pa.binary())], ["part", "block"])


def _as_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _summed(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(["lang", "length", "phrase"]).aggregate([("n", "sum")])
    return sums.rename_columns(["lang", "length", "phrase", "n"])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[_Tokens]:
    for batch in batches:
        at = 0
        for texts in pieces(batch.column(0), PIECE):
            yield _Tokens(texts, batch.column(1).slice(at, len(texts)).cast(pa.string()))
            at += len(texts)


def _levels(tokens: _Tokens, maps: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, places, hashes, since) of phrases whose two parts have reached the threshold in the last of ``maps``.

    ``since`` is the first of the maps, oldest first, under which the phrase comes, so all shorter phrases in it come
    too. That its two parts are in a map does not suffice: a part's bit may be another phrase's while the part's own
    parts are not there yet. A word has no parts; all words come, from the first map on.
    """
    at, hashes, since = np.arange(len(tokens.hash)), tokens.hash, np.zeros(len(tokens.hash), dtype=np.int8)
    yield 1, at, hashes, since
    for length in range(2, longest + 1):
        good = in_bitmap(maps[-1], hashes)
        at, hashes, since = at[good], hashes[good], since[good]
        if len(at) < 2:
            return
        set_in = np.full(len(at), len(maps) - 1, dtype=np.int8)
        for k in range(len(maps) - 2, -1, -1):
            set_in[in_bitmap(maps[k], hashes)] = k
        ready = np.maximum(since, set_in)
        pair = np.flatnonzero((at[1:] == at[:-1] + 1))
        pair = pair[tokens.piece[at[pair]] == tokens.piece[at[pair] + length - 1]]
        prefix, since, at = hashes[pair], np.maximum(ready[pair], ready[pair + 1]), at[pair]
        hashes = extended(prefix, tokens.hash[at + length - 1])
        yield length, at, hashes, since


def _packed(bitmap: np.ndarray) -> bytes:
    """Few bits are set, so a bitmap travels compressed."""
    return zlib.compress(bitmap.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype=np.uint64)


def _block(low: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted values and their counts; steps between values are small, so the bytes of one place go together."""
    steps = np.diff(low, prepend=np.uint32(0))
    return zlib.compress(np.concatenate([steps, n.astype(np.uint32)]).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unblock(block: bytes) -> np.ndarray:
    """Values and counts of a block, each value in the upper half of a number and its count in the lower one."""
    flat = np.frombuffer(zlib.decompress(block), dtype=np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
    low, n = np.cumsum(flat[:len(flat) // 2], dtype=np.uint32), flat[len(flat) // 2:]
    return low.astype(np.uint64) << np.uint64(32) | n


_COUNTS = "part int, until int, block binary, hash long"


def _blocks(hashes: np.ndarray, until: int, least: int, part_bits: int) -> pa.RecordBatch:
    """Counts of hashes as one row for each part."""
    keys, n = _counted(hashes >> np.uint64(64 - LOW - part_bits))
    n = np.minimum(n, least)
    part, low = (keys >> np.uint64(LOW)).astype(np.int32), keys.astype(np.uint32)
    bounds = np.append(_edges(part), len(part))
    blocks = [_block(low[lo:hi], n[lo:hi]) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return pa.RecordBatch.from_arrays([
        pa.array(part[bounds[:-1]]), pa.array(np.full(len(blocks), until), pa.int32()), pa.array(blocks, pa.binary()),
        pa.nulls(len(blocks), pa.int64())], ["part", "until", "block", "hash"])


def _shard_counts(shard: DataFrame, shared: Broadcast[list[bytes]], step: int, shards: int, least: int, longest: int, part_bits: int) -> DataFrame:
    """Blocks of undecided phrases of a shard, with the step that ends their round.

    ``shared`` holds the bitmaps at the beginning of this step and of up to ``shards`` steps before, oldest first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [_unpacked(packed) for packed in shared.value]
        held: dict[int, list[np.ndarray]] = {begun: [] for begun in range(max(0, step - shards + 1), step + 1)}
        for tokens in _each(batches):
            for _, _, hashes, since in _levels(tokens, maps, longest):
                undecided = ~in_bitmap(maps[-1], hashes)
                # A phrase has one beginning, so those of each beginning are counted by themselves.
                for begun, waiting in held.items():
                    waiting.append(hashes[undecided & (since == begun - step + len(maps) - 1)])
            for begun, waiting in held.items():
                if sum(map(len, waiting)) >= CHUNK:
                    yield _blocks(np.concatenate(waiting), begun + shards - 1, least, part_bits)
                    waiting.clear()
        for begun, waiting in held.items():
            if any(map(len, waiting)):
                yield _blocks(np.concatenate(waiting), begun + shards - 1, least, part_bits)

    return shard.mapInArrow(count, _COUNTS)


def _merged(counts: DataFrame, step: int, least: int, part_bits: int) -> DataFrame:
    """Blocks of what is undecided after this step, one for each part and end of a round, and the hashes that have reached ``least``."""

    def summed(part: int, until: int, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        both = np.sort(np.concatenate([_unblock(block) for block in blocks]))
        low = (both >> np.uint64(32)).astype(np.uint32)
        edges = _edges(low)
        low, n = low[edges], np.add.reduceat(both & np.uint64(0xFFFFFFFF), edges)
        reached = n >= least
        hashes = (low[reached].astype(np.uint64) | np.uint64(part) << np.uint64(LOW)) << np.uint64(64 - LOW - part_bits)
        names = ["part", "until", "block", "hash"]
        if len(hashes):
            empty = [pa.nulls(len(hashes), kind) for kind in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(hashes.view(np.int64))], names)
        if until > step and not reached.all():
            yield pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([until], pa.int32()), pa.array([_block(low[~reached], n[~reached])]),
                pa.nulls(1, pa.int64())], names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by part and end, so one of these is in memory at a time.
        last, blocks = None, []
        for batch in batches:
            for part, until, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (part, until) != last and blocks:
                    yield from summed(*last, blocks)
                    blocks = []
                last = part, until
                blocks.append(block)
        if blocks:
            yield from summed(*last, blocks)

    return counts.repartition("part").sortWithinPartitions("part", "until").mapInArrow(merge, _COUNTS)


def _scan_in_circles(read: Callable[[int], DataFrame], shards: int, least: int, longest: int, bits: int) -> np.ndarray:
    """The bitmap of all phrases that reach the threshold, and perhaps of some that do not."""
    maps = [np.zeros(1 << bits - 6, dtype=np.uint64)]
    state = None
    # Parts grow as the root of the tasks do, so that neither a part nor the number of rows grows with all of the input.
    part_bits = 4 + read(0).rdd.getNumPartitions().bit_length() // 2
    for step in range(longest * shards):
        if step >= shards and (maps[-1] == maps[-1 - shards]).all():
            break
        shard = read(step % shards)
        shared = shard.sparkSession.sparkContext.broadcast([_packed(m) for m in maps[-1 - shards:]])
        counts = _shard_counts(shard, shared, step, shards, least, longest, part_bits)
        if state is not None:
            counts = counts.unionByName(state)
        merged = materialise(_merged(counts, step, least, part_bits), "running-counts")
        shared.destroy()
        maps.append(set_bits(maps[-1], merged.where("hash IS NOT NULL").select("hash")))
        state = merged.where("block IS NOT NULL")
    return maps[-1]


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                  longest: int = LONGEST, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(lang, length, phrase, n) of all phrases of 1 to ``longest`` words that occur ``least`` times or more in a language.

    One more row for each language has length 0, a null phrase and the number of all its words.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "phrase-shards")
    # Rows are dealt in turn, so that copies of one text go to all shards.
    docs.select(
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
    ).write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    written = spark.read.schema("text string, lang string, shard int").parquet(folder)
    reached = spark.sparkContext.broadcast(_packed(_scan_in_circles(
        lambda k: written.where(F.col("shard") == k).select("text", "lang"), shards, least, longest, bits)))

    # Texts take more room than hashes do, so their parts are smaller.
    part_bits = 7 + written.rdd.getNumPartitions().bit_length() // 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _unpacked(reached.value)
        kept = _Kept()
        for tokens in _each(batches):
            kept.count(tokens, frequent, longest)
            if len(kept.known) >= KEPT:
                yield kept.blocks(part_bits)
                kept = _Kept()
        yield kept.blocks(part_bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            rows = _summed(tables)
            rows = rows.filter(pc.or_(pc.greater_equal(rows["n"], least), pc.equal(rows["length"], 0)))
            return iter(rows.set_column(2, "phrase", rows["phrase"].cast(pa.string())).to_batches())

        last, tables, n = None, [], 0
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != last and tables:
                    yield from whole(tables)
                    tables, n = [], 0
                last = part
                tables.append(pa.ipc.open_stream(block.as_buffer()).read_all())
                n += len(tables[-1])
                if n > 2 * len(tables[0]) + CHUNK:
                    tables = [_summed(tables)]
                    n = len(tables[0])
        if tables:
            yield from whole(tables)

    blocks = written.select("text", "lang").mapInArrow(count, "part int, block binary")
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "lang string, length int, phrase string, n long")


def _parts_counted(cuts: DataFrame, side: str, counts: DataFrame, into: str) -> DataFrame:
    """``cuts`` with the count of the part in a column; each part's count is found once, whatever number of cuts has it."""
    uses = cuts.groupBy(side).agg(F.count("*").alias("uses"))
    table = materialise(uses.join(counts.select(F.struct("lang", "phrase").alias(side), F.col("n").alias(into)), side), f"{side}-parts")
    return join_frequent_apart(cuts, table, [side], "uses", cuts.count())


def _part(words: Column, start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    Texts are lower-cased (A-Z) and cut into pieces at full stops, commas, semicolons, colons,
    exclamation and question marks and line breaks; pieces into words at blanks and tabs.
    ``a`` counts a phrase's occurrences inside pieces, ``l`` and ``r`` those of the two parts at
    its weakest cut (ties: after the fewest words), ``n`` the language's words, and
    ``score`` is floor(2000000 * a / (l + r)) there. A phrase inside a longer one that has at
    least 80 % of its occurrences goes. A null language counts as ``und``; a null or empty
    text has no words; repeated rows count again; ids and other columns are not read. A
    language without phrases gives no rows, nor does an empty table. Ties of score and count
    are ordered by the phrase's UTF-8 bytes. Phrases are told apart by 64-bit hashes within a
    task's batch and by their text after it.
    """
    counts = materialise(phrase_counts(docs, text_col, lang_col, least, longest, shards, bits), "phrase-counts")
    phrases = counts.where("length > 0")
    candidates = phrases.where("length > 1").withColumn("words", F.split("phrase", " "))
    # A longer phrase that is frequent enough has one in between that is too, so one word more is all to look at.
    around = (
        candidates.where("length > 2")
        .select("lang", F.col("n").alias("longer"), F.explode(F.array(
            _part(F.col("words"), 1, F.col("length") - 1), _part(F.col("words"), 2, F.col("length") - 1))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    kept = candidates.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (exact("longer") * 100 < exact("n") * HELD)).drop("longer")
    cuts = kept.select(
        "lang", "phrase", F.col("n").alias("a"), "words", "length", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.struct("lang", _part(F.col("words"), 1, F.col("k")).alias("phrase")).alias("first"),
        F.struct("lang", _part(F.col("words"), F.col("k") + 1, F.col("length") - F.col("k")).alias("phrase")).alias("rest"))
    # Both by themselves: a text that joins them would depend on what a language's name may hold.
    cuts = _parts_counted(materialise(cuts, "phrase-cuts"), "first", phrases, "l")
    cuts = _parts_counted(materialise(cuts, "left-counted-cuts"), "rest", phrases, "r")
    scored = cuts.withColumn("score", F.expr(f"({SCALE}BD * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    totals = counts.where("length = 0").select("lang", F.col("n").alias("total"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    best = weakest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return lookup(best, "lang", totals).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")


def collocations_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same rows by counting every phrase."""
    grams = "\nUNION ALL\n".join(
        f"SELECT lang, {k} AS length, list_aggregate(words[i:i + {k - 1}], 'string_agg', ' ') AS phrase "
        f"FROM pieces, unnest(range(1, len(words) - {k - 2})) AS t(i)" for k in range(1, 5))
    return f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
grams AS (SELECT lang, length, phrase, count(*) AS n FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
candidates AS (SELECT lang, length, phrase, n AS a, string_split(phrase, ' ') AS words FROM grams WHERE length > 1),
kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.length > c.length AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')
      AND 100::HUGEINT * d.a >= 80::HUGEINT * c.a)),
cuts AS (
  SELECT lang, phrase, a, k, list_aggregate(words[1:k], 'string_agg', ' ') AS first, list_aggregate(words[k + 1:], 'string_agg', ' ') AS rest
  FROM kept, unnest(range(1, length)) AS t(k)),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, f.n AS l, s.n AS r, (2000000::HUGEINT * a) // (f.n + s.n) AS score
  FROM cuts c JOIN grams f ON f.lang = c.lang AND f.phrase = c.first JOIN grams s ON s.lang = c.lang AND s.phrase = c.rest),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  t.n::BIGINT AS n, score::BIGINT AS score
FROM weakest w JOIN totals t ON t.lang = w.lang
QUALIFY rank <= {top}
"""

"""What the operators share: the word rule, column expressions for it, and Arrow helpers for tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Texts are handled in tasks in pieces of about so many bytes (one text at least).
PIECE_BYTES = 8_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def pieces(texts: pa.Array, size: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Slices of a text array holding about ``size`` bytes each; nulls become empty texts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        yield texts.slice(at, min(stop, len(texts)) - at)
        at = min(stop, len(texts))


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(bounds, codes, distinct): the words of text ``i`` are ``distinct[codes[bounds[i]:bounds[i + 1]]]``."""
    # The splitter gives empty strings for white space at either end.
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        owner = np.repeat(np.arange(len(texts)), lengths)[full]
        lengths = np.bincount(owner, minlength=len(texts))
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), codes, coded.dictionary


def byte_rows(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): all words' UTF-8 one after the other, and where each begins and ends."""
    words = words.cast(pa.large_binary())
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def hash64(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte string: the sum of a mix of its bytes with their places, mixed again."""
    n = len(bounds) - 1
    lengths = np.diff(bounds)
    with np.errstate(over="ignore"):
        place = (np.arange(len(data)) - np.repeat(bounds[:-1], lengths)).astype(np.uint64)
        mixed = (data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * (place * np.uint64(2) + np.uint64(0xD6E8FEB86659FD93))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        out = (sums[bounds[1:]] - sums[bounds[:-1]]) + lengths.astype(np.uint64)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(29)
    return out if n else np.zeros(0, np.uint64)


def word_spans(word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of word bytes; a stretch does not cross ``bounds``, where texts begin."""
    edge = np.zeros(len(word) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[False], word[:-1]]) & ~edge[:-1]
    after = np.concatenate([word[1:], [False]]) & ~edge[1:]
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes at a time; ``hash64`` for the few spans beyond 64 bytes."""
    out = (ends - starts).astype(np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
    rows = np.flatnonzero(ends - starts <= 64)
    for k in range(0, 64, 8):
        left = ends[rows] - starts[rows] - k
        rows, left = rows[left > 0], left[left > 0]
        if not len(rows):
            break
        value = eights[starts[rows] + k]
        short = left < 8
        value[short] &= (np.uint64(1) << (left[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[rows] = extended(out[rows], value)
    long_ = np.flatnonzero(ends - starts > 64)
    if len(long_):
        out[long_] = hash64(np.concatenate([data[starts[i]:ends[i]] for i in long_]), np.concatenate([[0], np.cumsum((ends - starts)[long_])]))
    return out


def extended(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of all but its last word and that word's."""
    with np.errstate(over="ignore"):
        out = head * np.uint64(0x9E3779B97F4A7C15) + word
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit that the first bits of each hash name is set."""
    place = hashes >> np.uint64(64 - (int(len(bitmap) * 64).bit_length() - 1))
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def set_bits(bitmap: np.ndarray, hashes: DataFrame) -> np.ndarray:
    """The bitmap with the bits of a column ``hash``; one row for each 64 bits reaches the driver."""
    bits = int(len(bitmap) * 64).bit_length() - 1
    words = hashes.groupBy(F.shiftrightunsigned("hash", 64 - bits + 6).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63L AS INT)))").alias("bits")).toArrow()
    out = bitmap.copy()
    out[words["word"].to_numpy()] |= words["bits"].to_numpy().view(np.uint64)
    return out

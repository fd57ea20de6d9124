"""Benchmark passages in documents, found by latent semantic retrieval and confirmed word by word.

1. Terms are words without case and outer punctuation, hashed to ``BUCKETS`` buckets. Their
   inverse document frequencies come from all documents. Terms in more than ``STOP_SHARE``
   of these weigh nothing, unless an item, such as one that is everywhere, mainly consists
   of them.
2. The benchmark's passages, runs of ``WINDOW`` words, are rows of a TF-IDF matrix. Its
   leading right singular vectors come from a randomised SVD (Halko et al. 2011): each
   step is one pass over the passages in which tasks add up the products with a narrow
   matrix; what reaches the driver has at most ``BUCKETS`` times ``RANK`` + ``EXTRA`` numbers.
3. Every document is read in overlapping windows of ``WINDOW`` words. A window and a passage
   whose latent vectors have a cosine of at least ``COSINE`` are a candidate, if the window's
   vector along the passage's is at least ``HELD`` times as long: one that holds the passage
   holds all of its vector besides its own.
4. Besides, every item that shares enough neighbouring words with a stretch of text is a
   candidate, whatever the latent vectors say. Of an item of n words a common subsequence of
   k keeps at least 2 k - n - 1 pairs of neighbours; so many pairs of the item are looked for
   in twice its length. This finds all items that are there word for word, or with words
   replaced or left out up to ``LCS_SHARE``, however large the benchmark is. What has words
   put in between as well depends on the latent search.
5. A candidate is confirmed on the words around the window: the longest common subsequence
   must hold ``LCS_SHARE`` of the item's words, distinct words worth ``WEIGHT_SHARE`` of its
   inverse document frequencies must be there, and of its answer, which is its last sentence
   (of a single sentence the last third), ``ANSWER_SHARE`` must be there in order. An item
   of fewer than ``SHORT`` words must be there word for word.

Documents are read twice and never shuffled. Benchmarks of more than ``BLOCK`` passages are
searched for in blocks, each a pass of its own, so what is broadcast has a bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.words import byte_rows, coded_words, hash64, pieces
from tallywatch.sources.scratch import materialise

BUCKETS = 1 << 16
WINDOW = 64
STRIDE = WINDOW // 2
RANK = 96
EXTRA = 8
PASSES = 3
COSINE = 0.5
HELD = 0.4
LCS_SHARE = 0.6
WEIGHT_SHARE = 0.6
ANSWER_SHARE = 0.5
SHORT = 8
BLOCK = 5_000
STOP_SHARE, STOP_TEXTS = 0.05, 100
PIECE = 1_500_000
HITS = 2_000_000
OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def _terms(distinct: pa.Array) -> np.ndarray:
    """Hash of every word without outer ASCII punctuation and case; words of punctuation alone hash as empty."""
    return hash64(*byte_rows(pc.ascii_trim(pc.utf8_lower(distinct), characters=OUTER)))


def _bucket(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(40)).astype(np.int64) % BUCKETS


EMPTY = hash64(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0]


def item_terms(text: str | None) -> tuple[np.ndarray, int]:
    """The terms of a text in order, and where its answer begins."""
    bounds, codes, distinct = coded_words(pa.array([text or ""], pa.large_string()))
    if not len(codes):
        return np.zeros(0, np.uint64), 0
    ends = np.array([w.rstrip("\"')]").endswith((".", "?", "!", ":")) for w in distinct.to_pylist()])[codes]
    terms = _terms(distinct)[codes]
    breaks = np.flatnonzero(ends[:-1])
    start = int(breaks[-1]) + 1 if len(breaks) else len(codes) - max(1, len(codes) // 3)
    real = terms != EMPTY
    return terms[real], int(real[:start].sum())


@dataclass
class Items:
    """A block of benchmark items as tasks need them."""

    ids: list
    terms: list[np.ndarray]
    answers: list[int]
    owner: np.ndarray
    latent: np.ndarray
    length: np.ndarray
    basis: np.ndarray
    idf: np.ndarray

    def __post_init__(self):
        """The sorted keys of all neighbouring pairs, and the items that hold each."""
        pairs = [np.unique(_pairs(t)) if len(t) > 1 else _pairs(np.append(t, EMPTY)) for t in self.terms]
        keys = np.concatenate([np.zeros(0, np.uint64), *pairs])
        item = np.repeat(np.arange(len(pairs)), [len(x) for x in pairs])
        order = np.argsort(keys, kind="stable")
        self.pair_items = item[order]
        self.pair_keys, self.pair_first = np.unique(keys[order], return_index=True)
        self.pair_first = np.append(self.pair_first, len(keys))
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.terms]))
        self.sizes = np.array([len(t) for t in self.terms], np.int64)
        kept = np.ceil(LCS_SHARE * self.sizes - 1e-9).astype(np.int64)
        self.least_pairs = np.maximum(1, np.where(self.sizes < SHORT, self.sizes - 1, 2 * kept - self.sizes - 1))


def _pairs(terms: np.ndarray) -> np.ndarray:
    """A key for each term and the one after it; an item of one term is paired with ``EMPTY``."""
    with np.errstate(over="ignore"):
        return (terms[:-1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) ^ (terms[1:] * np.uint64(0xBF58476D1CE4E5B9))


def _passages(n: int) -> list[tuple[int, int]]:
    """The runs of ``WINDOW`` words, every ``STRIDE``, that cover ``n`` words."""
    return [(a, min(n, a + WINDOW)) for a in range(0, max(1, n - STRIDE), STRIDE)] if n else []


def document_frequencies(docs: DataFrame, text_col: str, wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many texts each wanted bucket occurs, and the number of texts; all documents count."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for texts in pieces(batch.column(0), PIECE):
                bounds, codes, distinct = coded_words(texts)
                bucket = _bucket(_terms(distinct))
                bucket = np.where(shared.value[bucket], bucket, -1)[codes]
                text = np.repeat(np.arange(len(texts)), np.diff(bounds))
                use = bucket >= 0
                seen = np.unique(text[use] * BUCKETS + bucket[use]) % BUCKETS
                total += np.bincount(seen, minlength=BUCKETS + 1)
                total[BUCKETS] += len(texts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out[:BUCKETS], int(out[BUCKETS])


def _without_stop_terms(idf: np.ndarray, frequent: np.ndarray, items: list[np.ndarray]) -> np.ndarray:
    """Zero weight for frequent terms, but for those of items that would lose half their weight."""
    needed = np.zeros(BUCKETS, bool)
    for bucket in items:
        if idf[bucket][frequent[bucket]].sum() > 0.5 * idf[bucket].sum():
            needed[bucket] = True
    return np.where(frequent & ~needed, 0.0, idf)


def benchmark_passages(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, buckets): the buckets of every passage, repeats included."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for item, text in zip(frame["item"], frame["text"]):
                terms, _ = item_terms(text)
                rows += [(item, _bucket(terms[a:b]).tolist()) for a, b in _passages(len(terms))]
            yield pd.DataFrame(rows, columns=["item", "buckets"])

    item = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return item.mapInPandas(cut, "item string, buckets array<int>")


def _signs(buckets: np.ndarray, width: int) -> np.ndarray:
    """The random matrix's rows of these buckets: plus and minus one, by a hash."""
    with np.errstate(over="ignore"):
        x = buckets.astype(np.uint64)[:, None] * np.uint64(1_000_003) + np.arange(width, dtype=np.uint64)
        x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
    return np.where((x >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def latent_basis(passages: DataFrame, idf: np.ndarray, rank: int = RANK, passes: int = PASSES) -> np.ndarray:
    """The leading right singular vectors of the passages' TF-IDF matrix, one row for each bucket."""
    width = rank + EXTRA
    used = np.flatnonzero(idf)
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    narrow = _signs(used, width)
    spark = passages.sparkSession
    product = np.zeros((len(used), width))
    for _ in range(passes):
        shared = spark.sparkContext.broadcast((place, idf[used], narrow))

        def multiply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            place, weight, narrow = shared.value  # noqa: B023
            gram = np.zeros((width, width))
            back = np.zeros((len(weight), width))
            for frame in frames:
                for buckets in frame["buckets"]:
                    at = place[np.asarray(buckets)]
                    at, n = np.unique(at[at >= 0], return_counts=True)
                    row = n * weight[at]
                    row = row / (np.linalg.norm(row) or 1.0)
                    y = row @ narrow[at]
                    gram += np.outer(y, y)
                    back[at] += np.outer(row, y)
            some = np.flatnonzero(back.any(axis=1))
            keys = np.concatenate([-1 - np.arange(width), some])
            yield pd.DataFrame({"key": keys, "values": list(np.concatenate([gram, back[some]]))})

        sums = passages.mapInPandas(multiply, "key int, values array<double>").select(
            "key", F.posexplode("values").alias("j", "v")).groupBy("key", "j").agg(F.sum("v").alias("v"))
        rows = sums.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("j", "v")))["v"].alias("values")).collect()
        gram, product = np.zeros((width, width)), np.zeros((len(used), width))
        for r in rows:
            if r["key"] < 0:
                gram[-1 - r["key"]] = r["values"]
            else:
                product[r["key"]] = r["values"]
        # With the product's columns made orthonormal this is the projection of the matrix on them.
        size, turn = np.linalg.eigh(gram)
        good = size > 1e-9 * max(size.max(), 1e-300)
        product = product @ (turn[:, good] / np.sqrt(size[good])) if good.any() else product[:, :0]
        narrow = np.zeros((len(used), width))
        narrow[:, : product.shape[1]] = product
    left, sizes, _ = np.linalg.svd(product, full_matrices=False) if product.size else (product, np.zeros(0), None)
    keep = min(rank, int((sizes > 1e-6 * max(sizes.max(initial=0), 1e-300)).sum()))
    basis = np.zeros((BUCKETS, max(1, keep)), np.float32)
    basis[used, :keep] = left[:, :keep]
    return basis


def fit(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
        item_text_col: str = "text") -> list[Items]:
    """The items to look for, in blocks of at most ``BLOCK`` passages, with basis and weights.

    Items whose text is null or has no term are left out. Each block has its own basis.
    """
    items = materialise(benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")), "benchmark")
    passages = materialise(benchmark_passages(items, "item", "text"), "passages")
    n_blocks = max(1, -(-passages.count() // BLOCK))
    part = lambda item: F.pmod(F.xxhash64(item.cast("string")), F.lit(n_blocks))
    blocks = []
    for k in range(n_blocks):
        mine = passages.where(part(F.col("item")) == k)
        wanted = np.zeros(BUCKETS, bool)
        # At most BUCKETS rows.
        for r in mine.select(F.explode("buckets").alias("b")).distinct().collect():
            wanted[r["b"]] = True
        if not wanted.any():
            continue
        seen, n = document_frequencies(docs, text_col, wanted)
        idf = np.where(wanted, np.log((1 + n) / (1 + seen)) + 0.1, 0.0)
        rows = sorted(((r["item"], r["text"]) for r in items.where(part(F.col("item")) == k).collect()), key=repr)
        found = [(item, *item_terms(text)) for item, text in rows]
        found = [x for x in found if len(x[1])]
        idf = _without_stop_terms(idf, seen > np.maximum(STOP_SHARE * n, STOP_TEXTS), [_bucket(x[1]) for x in found])
        basis = latent_basis(mine, idf)
        owner, latent = [], []
        for i, (_, terms, _) in enumerate(found):
            for a, b in _passages(len(terms)):
                bucket = _bucket(terms[a:b])
                owner.append(i)
                latent.append((basis[bucket] * idf[bucket][:, None]).sum(axis=0))
        latent = np.array(latent, np.float32)
        length = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)
        blocks.append(Items([x[0] for x in found], [x[1] for x in found], [x[2] for x in found], np.array(owner),
                            latent / length[:, None], length, basis, idf.astype(np.float32)))
    return blocks


def lcs_mask(terms: np.ndarray) -> dict[int, int]:
    """For each term the places it has in the item, as bits."""
    places: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        places[t] = places.get(t, 0) | (1 << i)
    return places


def lcs_row(places: dict[int, int], n: int, words: list[int]) -> int:
    """Bits of the item's words in one longest common subsequence with ``words`` (Hyyro 2004)."""
    full = (1 << n) - 1
    v = full
    for w in words:
        u = v & places.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return ~v & full


class _Judge:
    """Confirms candidates of one block."""

    def __init__(self, items: Items):
        self.items = items
        self.places = [lcs_mask(t) for t in items.terms]
        self.weight = [{t: float(items.idf[b]) for t, b in zip(x.tolist(), _bucket(x))} for x in items.terms]
        self.least = [WEIGHT_SHARE * sum(w.values()) for w in self.weight]

    def confirm(self, i: int, words: list[int]) -> int:
        """The length of the common subsequence if the item is there, else 0."""
        terms, n = self.items.terms[i], len(self.items.terms[i])
        if n < SHORT:
            own = terms.tolist()
            return n if any(words[k:k + n] == own for k in range(len(words) - n + 1)) else 0
        # The cheapest check first: most candidates lack the item's rare words.
        weight, there = self.weight[i], set(words)
        if sum(w for t, w in weight.items() if t in there) < self.least[i]:
            return 0
        common = lcs_row(self.places[i], n, words).bit_count()
        if common < LCS_SHARE * n:
            return 0
        at = self.items.answers[i]
        answer = terms[at:]
        if lcs_row(lcs_mask(answer), len(answer), words).bit_count() < ANSWER_SHARE * len(answer):
            return 0
        return common


def _paired(terms: np.ndarray, codes: np.ndarray, bounds: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, begin, end): stretches around enough of an item's neighbouring pairs within twice its length."""
    known = np.isin(terms, items.known)[codes]
    follows = known[:-1] & known[1:]
    follows[bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(codes))] - 1] = False
    at = np.flatnonzero(follows)
    with np.errstate(over="ignore"):
        left = terms * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
        right = np.append(terms, EMPTY) * np.uint64(0xBF58476D1CE4E5B9)
    keys = left[codes[at]] ^ right[codes[at + 1]]
    if (items.sizes == 1).any():
        single = np.flatnonzero(known)
        keys = np.concatenate([keys, left[codes[single]] ^ right[-1]])
        at = np.concatenate([at, single])
    if not len(keys) or not len(items.pair_keys):
        return
    spot = np.minimum(np.searchsorted(items.pair_keys, keys), len(items.pair_keys) - 1)
    hit = items.pair_keys[spot] == keys
    at, spot = at[hit], spot[hit]
    text = np.searchsorted(bounds, at, side="right") - 1
    n = items.pair_first[spot + 1] - items.pair_first[spot]
    cells = int(np.diff(bounds).max(initial=0)) + 2
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    # So many hits at a time: a pair that many items hold has one for each.
    for some in np.split(np.arange(len(at)), np.searchsorted(np.cumsum(n), np.arange(HITS, n.sum(), HITS))):
        each = np.repeat(some, n[some])
        if not len(each):
            continue
        within = np.arange(len(each)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        item = items.pair_items[items.pair_first[spot[each]] + within]
        cell = (at[each] - bounds[text[each]]) // items.sizes[item]
        new, more = np.unique((text[each] * len(items.terms) + item) * cells + cell, return_counts=True)
        found, back = np.unique(np.concatenate([found, new]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, more])).astype(np.int64)
    if not len(found):
        return
    item = found // cells % len(items.terms)
    both = counts.copy()
    next_to = found[1:] == found[:-1] + 1
    both[:-1][next_to] += counts[1:][next_to]
    for k in np.flatnonzero(both >= items.least_pairs[item]):
        i, begin = int(item[k]), int(found[k] % cells) * int(items.sizes[item[k]])
        # The stretch may begin before its first pair.
        yield int(found[k] // cells // len(items.terms)), i, max(0, begin - int(items.sizes[i])), begin + 2 * int(items.sizes[i])


def _search(texts: pa.Array, items: Items, judge: _Judge) -> list[list[tuple]]:
    """For each text the items found in it: (place in the block, cosine, common words, item's words)."""
    bounds, codes, distinct = coded_words(texts)
    terms = _terms(distinct)
    if (terms == EMPTY).any():
        keep = terms[codes] != EMPTY
        upto = np.concatenate([[0], np.cumsum(keep)])
        bounds, codes = upto[bounds], codes[keep]
    bucket = _bucket(terms)
    vectors = items.basis[bucket] * items.idf[bucket][:, None]
    hit = (items.idf[bucket] > 0)[codes]
    # Sums over runs of half a window; a window is two neighbouring runs of one text.
    sizes = np.diff(bounds)
    halves = np.maximum(1, -(-sizes // STRIDE))
    first = np.concatenate([[0], np.cumsum(halves)])
    text = np.repeat(np.arange(len(texts)), sizes)
    half = first[text] + (np.arange(len(codes)) - bounds[text]) // STRIDE
    sums = np.zeros((first[-1], vectors.shape[1]), np.float32)
    at = half[hit]
    if len(at):
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sums[at[new]] = np.add.reduceat(vectors[codes[hit]], new, axis=0)
    owner = np.repeat(np.arange(len(texts)), halves)
    paired = np.zeros(len(owner), bool)
    paired[:-1] = owner[1:] == owner[:-1]
    windows = sums.copy()
    windows[:-1][paired[:-1]] += sums[1:][paired[:-1]]
    size = np.maximum(np.linalg.norm(windows, axis=1), 1e-9)
    out: list[dict] = [{} for _ in range(len(texts))]
    for begin in range(0, len(windows), 20_000):
        along = windows[begin:begin + 20_000] @ items.latent.T
        cosines = along / size[begin:begin + 20_000, None]
        for w, p in zip(*np.nonzero((cosines >= COSINE) & (along >= HELD * items.length))):
            cosine, w = float(cosines[w, p]), w + begin
            i, t = int(items.owner[p]), int(owner[w])
            if i in out[t]:
                out[t][i] = (max(cosine, out[t][i][0]), *out[t][i][1:])
                continue
            n = len(items.terms[i])
            start = bounds[t] + (w - first[t]) * STRIDE
            words = terms[codes[max(bounds[t], start - n):min(bounds[t + 1], start + WINDOW + n)]].tolist()
            common = judge.confirm(i, words)
            if common:
                out[t][i] = (cosine, common, n)
    for t, i, begin, end in _paired(terms, codes, bounds, items):
        if i in out[t]:
            continue
        common = judge.confirm(i, terms[codes[bounds[t] + begin:min(bounds[t + 1], bounds[t] + end)]].tolist())
        if common:
            here = slice(first[t] + max(0, begin // STRIDE - 1), min(first[t + 1], first[t] + end // STRIDE + 1))
            cosine = (windows[here] @ items.latent[items.owner == i].T / size[here, None]).max()
            out[t][i] = (float(cosine), common, len(items.terms[i]))
    return [[(i, *x) for i, x in sorted(found.items())] for found in out]


def _found(items: Items, spark) -> object:
    shared = spark.sparkContext.broadcast(items)

    @F.arrow_udf("array<struct<place int, cosine double, lcs int, item_words int>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _Judge(shared.value)
        kind = pa.list_(pa.struct([("place", pa.int32()), ("cosine", pa.float64()), ("lcs", pa.int32()), ("item_words", pa.int32())]))
        for batch in batches:
            rows = [[dict(zip(("place", "cosine", "lcs", "item_words"), x)) for x in found]
                    for texts in pieces(batch, PIECE) for found in _search(texts, shared.value, judge)]
            yield pa.array(rows, kind)

    return search


def matches(docs: DataFrame, blocks: list[Items], id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_type: str = "long") -> DataFrame:
    """(id, item, cosine, lcs, item_words): every benchmark item found in a document, once for each row of ``docs``.

    Null and empty texts hold no item. Null ids are kept. Without items there are no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    out = None
    for items in blocks:
        # At most BLOCK names.
        names = F.broadcast(spark.createDataFrame(list(enumerate(items.ids)), f"place int, {item_col} {item_type}"))
        here = rows.select(id_col, F.explode(_found(items, spark)(F.col("_text"))).alias("m")).select(id_col, "m.*")
        here = here.join(names, "place").select(id_col, item_col, "cosine", "lcs", "item_words")
        out = here if out is None else out.unionByName(here)
    if out is None:
        out = rows.limit(0).select(id_col, F.lit(None).cast(item_type).alias(item_col), F.lit(0.0).alias("cosine"),
                                   F.lit(0).alias("lcs"), F.lit(0).alias("item_words"))
    return out


def clean(blocks: list[Items], text: Column, spark) -> Column:
    """True where a text holds no item."""
    ok = F.lit(True)
    for items in blocks:
        ok = ok & (F.size(_found(items, spark)(text)) == 0)
    return ok


def keep_clean(docs: DataFrame, blocks: list[Items], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    return docs.where(clean(blocks, F.col(text_col), docs.sparkSession))

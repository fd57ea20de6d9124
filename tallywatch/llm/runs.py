"""Periodic runs of words, by maximal pairs of equal stretches (Gusfield 1997; Brodal and others 2000).

A run is a stretch of words with smallest period q, at least ``max(least, 2 * q)`` words
long, that no neighbouring word extends with that period. Two occurrences of a stretch
of L words, p words apart, whose neighbours differ on the left and on the right, are a
maximal pair. If p <= L, the words from the first occurrence's beginning to the second
one's end have period p, and because the neighbours differ nothing extends them. So the
maximal pairs with p <= L and L + p >= ``least`` are exactly the runs, each found once
for its smallest period and perhaps again for multiples of it; the smallest one is kept.

Maximal pairs come from the LCP-interval tree of a text's suffixes. It is gone through
from the leaves up. A node carries the beginnings below it in lists by the word to their
left. Where children meet, beginnings of different children (their right neighbours
differ) and of different lists (their left neighbours differ) pair up, the smaller side
searching the larger one's sorted lists for partners within the node's depth; then the
lists are joined, the smaller into the larger.

A pair needs L >= least / 2, so only beginnings whose first words, that many, recur in the
text enter the tree. They are found for whole batches of texts at once, and their order
and common lengths by prefix doubling, in numpy.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.words import byte_rows, coded_words, hash64, pieces

LEAST = 12
PIECE = 4_000_000
RESULT = T.StructType([
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType()),
])


def _recurring(codes: np.ndarray, owner: np.ndarray, tags: np.ndarray, width: int) -> np.ndarray:
    """Places whose first ``width`` words may begin at another place of the same text too.

    Told by hashes: none that recurs is left out, and one too many does no harm.
    """
    n = len(codes) - width + 1
    if n <= 1:
        return np.zeros(0, dtype=np.int64)
    tag = tags[codes]
    with np.errstate(over="ignore"):
        mixed = owner[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(width):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + tag[k:n + k]
    order = np.argsort(mixed)
    same = mixed[order[1:]] == mixed[order[:-1]]
    again = np.zeros(n, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    again &= owner[:n] == owner[width - 1:]
    return np.flatnonzero(again)


def _sorted_suffixes(codes: np.ndarray, owner: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their suffixes, words shared with the one before; 0 below ``width``).

    ``codes`` ends with ``width`` words that occur once, and every text ends with one of its own.
    """
    held = np.union1d(places, places + width)
    held = held[held < len(codes) - width]
    words = [codes[held + k] for k in range(width)]
    order = np.lexsort((*words[::-1], owner[held]))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = False
    for column in (owner[held], *words):
        fresh[1:] |= column[order[1:]] != column[order[:-1]]
    index = np.arange(len(order))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, index, 0))
    levels = [rank]
    size = width
    while True:
        # Groups of one are done; the others are told apart by the rank of what follows.
        edge = np.append(fresh, True)
        open_ = np.flatnonzero(~(edge[:-1] & edge[1:]))
        if not len(open_):
            break
        rows = order[open_]
        follow = rank[np.searchsorted(held, held[rows] + size)]
        again = np.lexsort((follow, rank[rows]))
        rows, follow = rows[again], follow[again]
        order[open_] = rows
        group = rank[rows]
        cut = np.ones(len(rows), dtype=bool)
        cut[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        fresh = fresh.copy()
        fresh[open_] = cut
        rank = rank.copy()
        rank[rows] = np.maximum.accumulate(np.where(cut, open_, 0))
        levels.append(rank)
        size *= 2
    # Common words of neighbours: whole levels from the longest down, then word by word.
    shared = np.zeros(len(order), dtype=np.int64)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = held[order[near - 1]], held[order[near]]
    common = np.zeros(len(near), dtype=np.int64)
    for t in range(len(levels) - 1, -1, -1):
        at, bt = np.searchsorted(held, a + common), np.searchsorted(held, b + common)
        inside = (at < len(held)) & (bt < len(held))
        same = np.zeros(len(near), dtype=bool)
        same[inside] = levels[t][at[inside]] == levels[t][bt[inside]]
        common[same] += width << t
    going = np.ones(len(near), dtype=bool)
    for _ in range(width - 1):
        going[going] = codes[a[going] + common[going]] == codes[b[going] + common[going]]
        common[going] += 1
    shared[near] = common
    return held[order], shared


class _Node:
    """Beginnings below a node of the tree: all of them sorted, and sorted lists by left word."""

    __slots__ = ("depth", "places", "lists")

    def __init__(self, place: int, left: int):
        self.depth = 0
        self.places = [place]
        self.lists = {left: [place]}


def _join(one: _Node, other: _Node, depth: int, least: int, left: list[int], found: dict[tuple[int, int], int]) -> _Node:
    """Report the pairs between two children of a node of this depth and put their lists together."""
    small, large = (one, other) if len(one.places) < len(other.places) else (other, one)
    places, lists = large.places, large.lists
    nearest = max(1, least - depth)
    for i in small.places:
        mine = left[i]
        lo, hi = bisect_left(places, i - depth), bisect_right(places, i + depth)
        if lo == hi:
            continue
        if hi - lo <= len(lists):
            partners = [j for j in places[lo:hi] if left[j] != mine]
        else:
            partners = [j for word, held in lists.items() if word != mine
                        for j in held[bisect_left(held, i - depth):bisect_right(held, i + depth)]]
        for j in partners:
            period = abs(i - j)
            if period >= nearest:
                span = (min(i, j), max(i, j) + depth)
                if found.get(span, period + 1) > period:
                    found[span] = period
    for i in small.places:
        insort(places, i)
    for word, held in small.lists.items():
        mine = lists.get(word)
        if mine is None:
            lists[word] = held
        else:
            for i in held:
                insort(mine, i)
    return large


def _tree_runs(places: list[int], shared: list[int], left: list[int], least: int, found: dict[tuple[int, int], int]) -> None:
    """The runs of one set of suffixes in order; ``shared[k]`` words are common to ``k - 1`` and ``k``."""
    stack: list[_Node] = []
    node = _Node(places[0], left[places[0]])
    for k in range(1, len(places) + 1):
        depth = shared[k] if k < len(places) else 0
        while stack and stack[-1].depth > depth:
            parent = stack.pop()
            node = _join(parent, node, parent.depth, least, left, found)
        if depth:
            if stack and stack[-1].depth == depth:
                parent = stack.pop()
                node = _join(parent, node, depth, least, left, found)
            node.depth = depth
            stack.append(node)
            node = _Node(places[k], left[places[k]])


def find_runs(bounds: np.ndarray, codes: np.ndarray, tags: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
    """The runs (start, length, period) of each text, by start and period.

    The words of text ``i`` are ``codes[bounds[i]:bounds[i + 1]]``; ``tags`` holds a hash for each code.
    """
    n = len(bounds) - 1
    out = [np.zeros((0, 3), dtype=np.int64)] * n
    width = max(1, -(-least // 2))
    # Every text gets a last word of its own, and the whole array ``width`` of them.
    lengths = np.diff(bounds)
    spaced = np.insert(codes, bounds[1:], len(tags) + np.arange(n))
    spaced = np.concatenate([spaced, len(tags) + n + np.arange(width)])
    owner = np.concatenate([np.repeat(np.arange(n), lengths + 1), np.full(width, n)])
    begin = bounds[:-1] + np.arange(n)
    own = np.arange(len(tags), len(tags) + n + width, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    places = _recurring(spaced, owner, np.concatenate([tags, own]), width)
    if not len(places):
        return out
    places, shared = _sorted_suffixes(spaced, owner, places, width)
    # Sets of suffixes with their first words in common; those too far apart for their depth hold no run.
    first = np.flatnonzero(shared == 0)
    last = np.append(first[1:], len(places))
    first, last = first[last - first > 1], last[last - first > 1]
    if not len(first):
        return out
    group = np.repeat(np.arange(len(first)), last - first)
    rows = np.repeat(first, last - first) + np.arange(len(group)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    near = places[rows][np.lexsort((places[rows], group))]
    gap = np.diff(near, prepend=near[0])
    size = np.cumsum(last - first) - (last - first)
    gap[size] = np.iinfo(np.int64).max
    hopeful = np.minimum.reduceat(gap, size) <= np.maximum.reduceat(shared[rows], size)
    found: dict[int, dict[tuple[int, int], int]] = {}
    for lo, hi in zip(first[hopeful].tolist(), last[hopeful].tolist()):
        text = int(owner[places[lo]])
        start = int(begin[text])
        if text not in found:
            words = spaced[start:start + int(lengths[text])].tolist()
            found[text] = {}
            left = [-1, *words]
        _tree_runs((places[lo:hi] - start).tolist(), shared[lo:hi].tolist(), left, least, found[text])
    for text, spans in found.items():
        if spans:
            rows_ = np.array([(a, b - a, p) for (a, b), p in spans.items()], dtype=np.int64)
            out[text] = rows_[np.lexsort((rows_[:, 2], rows_[:, 0]))]
    return out


def _collapsed(texts: list[np.ndarray], bounds: np.ndarray, codes: np.ndarray, distinct: pa.Array) -> pa.Array:
    """Every text's words but those that a run holds after its first period, joined by single blanks."""
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    for i, runs in enumerate(texts):
        if len(runs):
            np.add.at(change, bounds[i] + runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, bounds[i] + runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[bounds]
    words = distinct.take(pa.array(codes[kept])).cast(pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), " ")


def text_runs(texts: pa.Array, least: int = LEAST) -> tuple[list[np.ndarray], pa.Array]:
    """(runs, collapsed text) of every text of an array."""
    bounds, codes, distinct = coded_words(texts)
    runs = find_runs(bounds, codes, hash64(*byte_rows(distinct)), least)
    return runs, _collapsed(runs, bounds, codes, distinct)


def _result(texts: pa.Array, least: int) -> pa.Array:
    """One struct of runs and collapsed text for each text of a batch."""
    runs, collapsed = [], []
    for part in pieces(texts, PIECE):
        found, text = text_runs(part, least)
        runs += found
        collapsed.append(text.cast(pa.string()))
    flat = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"])
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(ends), spans), pa.concat_arrays(collapsed) if collapsed else pa.array([], pa.string())],
        ["runs", "collapsed"])


def collapse_runs(docs: DataFrame, text_col: str = "text", into: str = "periodic", least: int = LEAST) -> DataFrame:
    """``docs`` with a column ``into``, a struct of ``runs`` (start, length, period; words count from 0) and ``collapsed``.

    A column of that name is replaced. A null, empty or blank text has no words, so no
    run, and collapses to the empty text; a text without runs collapses to its words
    joined by single blanks. Equal rows give equal results. Ids and all other columns are
    carried along and not looked at. An empty table gives no rows. A long text is handled
    whole, by one task.
    """
    kept = [c for c in docs.columns if c != into]
    at = docs.columns.index(text_col)
    # By number, because names may have dots.
    places = [i for i, c in enumerate(docs.columns) if c != into]
    names = [f"c{i}" for i in (*places, len(docs.columns))]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in places], _result(batch.column(at), least)], names)

    types = [*[docs.schema[i].dataType for i in places], RESULT]
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return numbered.mapInArrow(each, T.StructType([T.StructField(n, t) for n, t in zip(names, types)])).toDF(*kept, into)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length (ties: smallest start, then period); null if there is none."""
    best = F.array_sort(F.transform(runs, lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.get(F.transform(best, lambda r: F.struct(r["start"].alias("start"), (-r["length"]).alias("length"), r["period"].alias("period"))), F.lit(0))


def runs_text(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")

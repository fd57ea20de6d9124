"""The size-aware join against all pairs."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.llm import jaccard
from tests.llm import edge


def shingles(text, width=5):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, share=80):
    """(id, size, smallest id reachable) of every row, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                group[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        root = find(i)
        if key is not None:
            least[root] = min(key, least.get(root, key))
    return sorted(((key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(rows)), key=str)


def made_up(seed, n=60):
    """Texts of all sizes with copies, edits at either end and in the middle, chains and a common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    common = [word() for _ in range(30)]
    texts = [None, "", " ", "One two", "one  TWO", "one two three four", "one two three four five"]
    for _ in range(n):
        base = [word() for _ in range(rng.choice([3, 5, 7, 8, 9, 10, 12, 15, 20, 40, 80, 150]))]
        if rng.random() < 0.3:
            base = common + base
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            base = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 40))):
                at = rng.randrange(len(base) + 1)
                kind = rng.random()
                if kind < 0.4:
                    base.insert(at, word())
                elif kind < 0.7:
                    base = base[1:] if rng.random() < 0.5 else base[:-1]
                elif at < len(base):
                    base[at] = word()
                base = base or [word()]
            texts.append(" ".join(base))
    rng.shuffle(texts)
    texts += texts[:10]
    return list(enumerate(texts)) + [(None, texts[12]), (None, "alone and without an id here"), (3, texts[20])]


def rows_of(out):
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed,options", [
    (1, {}), (2, {"largest": 0}), (3, {"largest": 9}), (4, {"largest": 12, "rounds": 0}), (5, {"cells": 2, "bits": 8, "rounds": 1}), (6, {"rounds": 2, "largest": 5}),
])
def test_classes_are_those_of_all_pairs(spark, seed, options):
    rows = made_up(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(want) - 30
    assert rows_of(jaccard.shingle_classes(docs, **options)) == want


def test_one_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts)) + [(500 + i, texts[0]) for i in range(50)]
    out = jaccard.shingle_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert rows_of(out) == brute(rows)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in edge.rows()]
    assert rows_of(jaccard.shingle_classes(edge.docs(spark))) == brute(rows)
    assert jaccard.shingle_classes(edge.empty(spark)).count() == 0
    odd = spark.createDataFrame([("b", "x y", {"k": 1}), ("a", "X  y", None)], "`the.id` string, `the.text` string, m map<string,long>")
    assert rows_of(jaccard.shingle_classes(odd, "the.id", "the.text")) == [("a", 1, "a"), ("b", 1, "a")]


def test_sets_of_a_batch():
    texts = ["a b c d e f a b c d e", "", "A b", "x"]
    sets = jaccard._Sets(pa.array(texts, pa.large_string()), 5)
    assert sets.sizes.tolist() == [len(shingles(t)) for t in texts]
    assert len(np.unique(sets.key)) == 4


def test_boundary_weighs_subsets_against_lists():
    assert jaccard.boundary({}) == 0
    assert jaccard.boundary({3: (10, 0.0), 20: (10, 5.0)}) == 0
    assert jaccard.boundary({3: (10, 100.0), 20: (10, 5.0)}) == 3
    assert jaccard.boundary({3: (10, 100.0), 10: (10, 10_000.0), 30: (1, 10.0)}) == 10


def test_overlaps():
    for share in (50, 80, 95):
        for s in range(1, 40):
            for t in range(s, 60):
                need = jaccard.least_overlap(s + t, share)
                linked = [o for o in range(s + 1) if 100 * o >= share * (s + t - o)]
                assert (min(linked) == need) if linked else need > s
                if linked:
                    assert s >= jaccard.least_partner(t, share) and need in jaccard.subset_sizes(s, t, share)


def test_span_hashes_tell_words_apart():
    from tallywatch.llm.words import span_hashes
    rng = random.Random(4)
    words = list({bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 90))) for _ in range(3000)})
    data = np.frombuffer(b" ".join(words) + b" " + b" ".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words * 2]) - 1
    hashes = span_hashes(data, ends - np.array([len(w) for w in words * 2]), ends)
    assert len(np.unique(hashes)) == len(words) and (hashes[:len(words)] == hashes[len(words):]).all()


def test_whole_sets_travel_in_less_room_than_their_hashes(spark):
    rng = random.Random(3)
    stock = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(rng.choice(stock).title() for _ in range(500)) for _ in range(20)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    made = jaccard._Sets(pa.array(texts), 5)
    keys = spark.createDataFrame([(k,) for k in made.key.view(np.int64).tolist()], "key long")
    rows = jaccard._whole_sets(frame, keys, 5, 12).collect()
    assert sum(len(r["words"]) for r in rows) < 0.5 * 8 * len(made.items)
    back = jaccard._Sets(pa.array([zlib.decompress(r["words"]) for r in rows], pa.large_binary()), 5)
    assert back.key.view(np.int64).tolist() == [r["key"] for r in rows] and sorted(back.key.tolist()) == sorted(made.key.tolist())

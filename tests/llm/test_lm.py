"""The lattice against enumeration of all cuts, the counts against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import lm
from tallywatch.llm.lattice import Lattice
from tallywatch.llm.words import bucket_of, byte_rows
from tests.llm import edge

SF = "/root/testdata/sf0.001"


def cuts(word, weights):
    """(probability, expected uses) by going through every cut."""
    if not word:
        return [(1.0, ())]
    return [(weights[word[:n]] * p, (word[:n], *rest)) for n in range(1, len(word) + 1) if word[:n] in weights
            for p, rest in cuts(word[n:], weights)]


def small():
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"abc", b"bc", b" ab", b"ca", "é".encode(), b" "})
    rng = np.random.default_rng(1)
    w = rng.random(len(pieces) + 1)
    return pieces, np.log(w / w.sum())


def test_lattice_adds_up_all_cuts():
    pieces, logp = small()
    weights = dict(zip(pieces, np.exp(logp)))
    words = ["a", "abc", "abcabc", "é", "bca", "xaby", "cabcab", "ab"]
    lattice = Lattice.of(pieces, logp)
    data, bounds = byte_rows(pa.array(words, pa.large_string()))
    got = lattice.log_probability(data, bounds)
    weight = np.arange(1.0, len(words) + 1)
    counts, want_counts = lattice.expected_counts(data, bounds, weight), Counter()
    for word, log_p, n in zip(words, got, weight):
        all_cuts = cuts(b" " + word.encode(), weights)
        total = sum(p for p, _ in all_cuts)
        assert log_p == pytest.approx(math.log(total))
        for p, parts in all_cuts:
            for part in parts:
                want_counts[part] += n * p / total
    assert all(counts[i] == pytest.approx(want_counts[p]) for i, p in enumerate(pieces))


def test_long_words():
    pieces, logp = small()
    data, bounds = byte_rows(pa.array(["ab" * 2000, "", "a"], pa.large_string()))
    out = Lattice.of(pieces, logp).log_probability(data, bounds)
    assert np.isfinite(out).all() and out[0] < out[2]


@pytest.mark.parametrize("head", [100_000, 50, 0])
@pytest.mark.parametrize("make", [edge.docs, lambda spark: spark.read.parquet(f"{SF}/documents.parquet")])
def test_base_scores(spark, head, make):
    docs = make(spark)
    held = bucket_of(F.col("doc_id"), 7) == 2
    model = lm.fit(docs, ~held, head=head)
    out = lm.score(docs, model).collect()
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    tokens = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", lower(r["text"])) + ["\n"]) for r in docs.collect()]
    trained = [t for i, t in tokens if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c = Counter(w for t in trained for w in t)
    n, v = sum(c.values()), len(c)
    assert (model.n, model.v) == (n, v)
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:3], round(r[3], 4))
    want = [(i, len(t), sum(c[w] > 0 for w in t), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for i, t in tokens]
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in out]
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert all(r["score"] < 0 for r in out)


def test_score_is_the_mixture(spark):
    docs = spark.createDataFrame([(1, "the the cat"), (3, "the dogs")], "doc_id long, text string")
    model = lm.fit(docs, F.col("doc_id") == 1)
    words = {r["word"]: r for r in model.words.collect()} | {r.word: r._asdict() for r in model.head.itertuples()}
    assert (model.n, model.v) == (4, 3)
    assert math.exp(words["the"]["score"]) == pytest.approx(2 / 7, abs=0.01)
    assert math.exp(words["the"]["score"]) > math.exp(words["cat"]["score"]) > math.exp(words["dogs"]["score"])
    out = {r["doc_id"]: r["score"] for r in lm.score(docs, model).collect()}
    assert out[3] == pytest.approx((words["the"]["score"] + words["dogs"]["score"] + model.end[1]) / math.log(10))


def test_nothing_to_learn_from(spark):
    docs = edge.docs(spark)
    out = lm.score(docs, lm.fit(docs, F.lit(False))).collect()
    assert len(out) == docs.count() and all(r["base_score"] == 0 and r["n_known"] == 0 for r in out)
    assert lm.score(edge.empty(spark), lm.fit(edge.empty(spark), F.lit(True))).count() == 0

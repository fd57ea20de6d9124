"""Retrieval, subsequence and answer checks against brute force."""

import random

import numpy as np
import pandas as pd
import pytest

from tallywatch.llm import decontaminate as d
from tests.llm import edge

SF = "/root/testdata/sf0.01"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + (x == y))
    return row[-1]


def test_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a = np.array([rng.randrange(5) for _ in range(rng.randint(1, 80))], np.uint64)
        b = [rng.randrange(6) for _ in range(rng.randint(0, 90))]
        assert d.lcs_row(d.lcs_mask(a), len(a), b).bit_count() == lcs(a.tolist(), b)


def word(rng):
    return "".join(rng.choice(["ba", "ko", "ri", "su", "te", "mo", "la"]) for _ in range(rng.randint(2, 4)))


def tables(spark):
    rng = random.Random(2)
    vocabulary = [word(rng) for _ in range(3000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: prose(rng.randint(15, 150)) for i in range(40)}
    for i in items:
        items[i][len(items[i]) // 2] += "."
    docs, want = [], set()
    for i in range(120):
        text = prose(rng.randint(30, 900))
        if i % 3 == 0:
            k, at = rng.randrange(40), rng.randrange(len(text))
            passage = list(items[k])
            if i % 2:  # a paraphrase: every sixth word another, some words left out
                passage = [vocabulary[0] if j % 6 == 5 else w for j, w in enumerate(passage) if j % 11 != 10]
            text[at:at] = [w.upper() if i % 4 == 0 else w for w in passage]
            want.add((i, k))
        docs.append((i, " ".join(text)))
    benchmark = [(i, " ".join(w)) for i, w in items.items()] + [(90, None), (91, "  "), (92, "zuzu zaza")]
    docs.append((500, "before zuzu zaza after"))
    docs.append((501, "zaza zuzu"))
    want.add((500, 92))
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string"), want)


@pytest.mark.parametrize("block", [5000, 30])
def test_exact_and_paraphrased_items(spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK", block)
    docs, benchmark, want = tables(spark)
    blocks = d.fit(docs, benchmark)
    assert (len(blocks) > 1) == (block == 30)
    out = d.matches(docs, blocks)
    got = {(r["doc_id"], r["item_id"]) for r in out.collect()}
    assert got == want
    kept = {r["doc_id"] for r in d.keep_clean(docs, blocks).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {a for a, _ in want}


def test_short_items_of_a_large_benchmark(spark):
    # Items of 8 to 14 words, each word for word in a text full of other items' words, or with a quarter replaced.
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 14))] for _ in range(3000)]
    items += [["zuzu"], ["zuzu", "zaza"]]
    docs = []
    for i in range(0, 3000, 10):
        text = [w for k in rng.sample(range(3000), 40) for w in rng.sample(items[k], 6)]
        passage = list(items[i])
        if i % 20:
            passage[1] = passage[4] = "zyzy"
        at = rng.randrange(len(text))
        docs.append((i, " ".join(text[:at] + passage + text[at:])))
    docs.append((3000, "a zuzu"))
    docs.append((3001, "zaza zuzu. zaza"))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in d.matches(docs, d.fit(docs, benchmark)).collect()}
    assert {(i, i) for i in range(0, 3000, 10)} | {(3000, 3000), (3001, 3000), (3001, 3001)} <= got


def test_every_planted_item_is_found(spark):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    norm = lambda x: " " + " ".join(w.strip(d.OUTER) for w in x.lower().split()) + " "
    texts = {r["doc_id"]: norm(r["text"]) for r in docs.collect()}
    want = {(i, r["item_id"]) for r in benchmark.collect() for i, t in texts.items() if norm(r["text"]) in t}
    got = {(r["doc_id"], r["item_id"]) for r in d.matches(docs, d.fit(docs, benchmark)).collect()}
    assert want and got == want


def test_basis_matches_a_full_decomposition(spark):
    rng = np.random.default_rng(4)
    lists = [rng.integers(0, 40, 30).tolist() for _ in range(25)]
    idf = np.zeros(d.BUCKETS)
    idf[:40] = rng.random(40) + 0.5
    frame = spark.createDataFrame(pd.DataFrame({"item": "a", "buckets": lists}), "item string, buckets array<int>")
    basis = d.latent_basis(frame, idf, rank=5, passes=8)[:40, :5]
    full = np.array([np.bincount(x, minlength=40) * idf[:40] for x in lists])
    full /= np.linalg.norm(full, axis=1, keepdims=True)
    values, right = np.linalg.svd(full)[1:]
    assert np.allclose(basis.T @ basis, np.eye(5), atol=1e-5)
    assert np.linalg.norm(full @ basis) == pytest.approx(np.linalg.norm(values[:5]), rel=1e-3)


def test_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, edge.rows()[9][1]), (2, None)], "item_id long, text string")
    docs = edge.docs(spark)
    blocks = d.fit(docs, benchmark)
    out = d.matches(docs, blocks).collect()
    want = sorted(t[0] for t in edge.rows() if t[1] == edge.rows()[9][1])
    assert sorted(r["doc_id"] for r in out) == want and {r["item_id"] for r in out} == {1}
    assert d.keep_clean(docs, blocks).count() == len(edge.rows()) - len(want)
    assert d.matches(edge.empty(spark), d.fit(edge.empty(spark), benchmark)).count() == 0
    nothing = d.fit(docs, benchmark.where("item_id = 2"))
    assert d.matches(docs, nothing).count() == 0 and d.keep_clean(docs, nothing).count() == docs.count()

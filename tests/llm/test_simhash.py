"""Fingerprints, the trie join and components against brute force."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallywatch.llm import simhash
from tallywatch.llm.components import connected_components
from tests.llm import edge


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance=3):
    """Smallest place reachable from each place, by comparing all pairs."""
    values = np.array(values, dtype=np.uint64)
    group = np.arange(len(values))
    for _ in range(len(values)):
        near = np.bitwise_count(values[:, None] ^ values[None]) <= distance
        after = np.where(near, group[None], len(values)).min(axis=1)
        if (after == group).all():
            return group
        group = after
    return group


def planted(rng, n):
    base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    out = [base]
    for bits in (1, 2, 3, 3, 4):
        flipped = base[: n // 2].copy()
        for _ in range(bits):
            flipped ^= np.uint64(1) << rng.integers(0, 64, len(flipped), dtype=np.uint64)
        out.append(flipped)
    # A dense group that shares its first bits and a chain.
    out.append(np.uint64(0xABCD << 48) + np.arange(60, dtype=np.uint64))
    return np.unique(np.concatenate(out))


@pytest.mark.parametrize("unit_rows", [50_000, 8])
def test_links_connect_what_all_pairs_connect(spark, unit_rows):
    values = planted(np.random.default_rng(1), 120)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash.linked_fingerprints(frame, unit_rows=unit_rows)
    roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
    label = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    want = classes(values)
    assert len(set(want)) < len(values)
    for a, b in zip(label, want):
        assert label[b] == a
    assert len(set(label)) == len(set(want))


def test_walk_merges_whole_nodes():
    values = np.sort(np.arange(16, dtype=np.uint64))
    seeds = np.array([[0, 16, 0, 16, 0, 0]])
    assert (simhash.link_groups(values, seeds, 3) == 0).all()


def test_near_duplicates_on_odd_rows(spark):
    out = simhash.near_duplicates(edge.docs(spark)).collect()
    texts = edge.rows()
    assert Counter(r["fingerprint"] for r in out) == Counter(f"{fingerprint(t[1]):016x}" for t in texts)
    blank = [r["component_id"] for r in out if r["fingerprint"] == "0" * 16]
    assert set(blank) == {0} and len(blank) == 4
    assert next(r for r in out if r["doc_id"] is None and r["fingerprint"] != "0" * 16)["component_id"] is None
    assert simhash.near_duplicates(edge.empty(spark)).count() == 0


def test_keep_one(spark):
    docs = edge.docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert Counter(ids) == Counter([0, 3, 4, 5, 6, 7, 8, 9, 10, None])
    assert simhash.keep_one(edge.empty(spark)).count() == 0


def test_keep_one_goes_by_group_not_by_id(spark):
    words = lambda k: " ".join(f"w{(k * 7919 + j * j * 31) % 99991}" for j in range(60))
    rows = [(None, words(k), {"k": k}) for k in range(20)]  # null ids, unrelated texts
    rows += [(7, words(100 + k), {"k": k}) for k in range(20)]  # one id, unrelated texts
    rows += [(None, words(100), None), (3, words(0), None)]  # a copy without an id, and one with
    rows += [(50, words(200), None)] * 40 + [(51, words(200), None)] * 40  # whole rows repeated
    rows += [(60, None, None), (60, "", None), (61, " ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,long>").repartition(5)
    out = Counter((r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect())
    want = {(None, words(k)) for k in range(1, 20)} | {(7, words(100 + k)) for k in range(20)}
    assert out == Counter(want | {(3, words(0)), (50, words(200)), (60, "")})


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    noise = [(7, 7), (None, 3), (200, 201), (201, 200)]
    out = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain + star + noise, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_frequent_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same words over and over").otherwise(
        F.concat(F.lit("w"), F.col("id"), F.lit(" text "), F.col("id") * 7)).alias("text"))
    out = simhash.near_duplicates(docs)
    assert out.count() == 3000
    assert out.where("doc_id % 3 = 0").select("component_id").distinct().count() == 1

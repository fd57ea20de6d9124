"""The mix against sums and a water level computed by hand."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallywatch.llm import mixing
from tallywatch.llm.permute import feistel
from tests.llm import edge


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        share = {s: (budget - sum(fixed.values())) * weight[s] / total for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 2 * sizes[s] for s in over})


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 257, 1000])
def test_permutation(spark, n):
    keyed = lambda k: [r[0] for r in spark.range(n).select(feistel(F.col("id"), F.lit(n).cast("long"), F.lit(k))).collect()]
    assert sorted(keyed(1)) == list(range(n))
    assert n < 64 or keyed(1) != keyed(2)


@pytest.mark.parametrize("part_rows", [4000, 3])
def test_totals_on_odd_rows(spark, part_rows):
    docs = edge.docs(spark)
    plan = mixing.mix(docs, block=16, part_rows=part_rows)
    out = mixing.document_totals(plan).collect()
    assert Counter((r["id"], r["size"]) for r in out) == Counter((t[0], n_words(t[1])) for t in edge.rows())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    sizes, taken = defaultdict(int), sum(r["taken"] for r in out)
    for t in edge.rows():
        sizes[t[3]] += n_words(t[1])
    want = targets(sizes)
    got = {r["source"]: (r["source_size"], r["target"]) for r in plan.sources.collect()}
    assert {s: v[0] for s, v in got.items()} == dict(sizes)
    assert all(v[1] == pytest.approx(want[s]) for s, v in got.items())
    assert taken == pytest.approx(sum(want.values()), abs=32 * len(sizes))
    again = mixing.document_totals(mixing.mix(docs.repartition(3), block=16, part_rows=part_rows)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_shards_hold_draws_of_every_source(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 50).alias("text"),
                                   F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("source"))
    plan = mixing.mix(docs, block=8, shard_slots=100)
    counts = plan.slots.groupBy("shard", "rank").agg(F.count("*").alias("n")).collect()
    total = plan.sources.agg(F.sum("slots")).first()[0]
    assert plan.slots.count() == total == plan.slots.select("slot").distinct().count()
    assert max(r["n"] for r in counts) > min(r["n"] for r in counts if r["rank"] == 0)
    uses = plan.slots.groupBy("rank", "block").agg(F.count("*").alias("n"))
    assert uses.agg(F.max("n")).first()[0] <= 2


def test_mixed_documents(spark):
    docs = edge.docs(spark)
    out = mixing.mixed_documents(docs, block=16)
    assert out.columns == docs.columns
    rows = out.collect()
    plan = mixing.mix(docs, block=16)
    taken = defaultdict(int)
    for r in mixing.document_totals(plan).collect():
        taken[r["id"]] += r["taken"]
    words = defaultdict(int)
    for r in rows:
        words[r["doc_id"]] += n_words(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert {k: v for k, v in taken.items() if v} == dict(words)
    originals = {t[1] for t in edge.rows()}
    assert any(r["text"] in originals for r in rows)
    assert mixing.mixed_documents(edge.empty(spark)).count() == 0

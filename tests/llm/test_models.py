"""The two networks: gradients, held-out accuracy, odd rows."""

import pathlib

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.llm import bigru, byteconv, langid, queries, toxicity
from tallywatch.llm.labelled import bounded_sample
from tallywatch.llm.words import byte_rows, coded_words
from tests.llm import edge

SF = "/root/testdata/sf0.01"


def test_sample_is_bounded(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN 'b' WHEN id % 7 = 0 THEN NULL ELSE 'a' END AS label")
    one, two = (sorted(r["id"] for r in bounded_sample(x, "label", "id", 60).collect()) for x in (rows, rows.repartition(5)))
    assert one == two and len(one) == 110


def test_windows_cover_every_byte():
    data, bounds = byte_rows(pa.array(["", "ab", "x" * 128, "y" * 129, "z" * 1000], pa.large_string()))
    windows, owner = byteconv.windows_of(data, bounds)
    assert np.bincount(owner).tolist() == [1, 1, 1, 2, 9]
    assert (windows[owner == 3] == ord("y")).sum() >= 129 and not windows[0].any()


def test_windows_cover_every_word():
    bounds, codes, distinct = coded_words(pa.array(["", "a", " ".join("w" * 200)], pa.large_string()))
    windows, owner = bigru.windows_of(bounds, codes, len(distinct))
    assert np.bincount(owner).tolist() == [1, 1, 6] and (windows[0] == len(distinct)).all()


def test_recurrent_gradients():
    """The hand-written backward pass against differences."""
    rng = np.random.default_rng(3)
    net = bigru.BiGru.fresh()
    gates = rng.normal(size=(7, 4, 3 * bigru.HIDDEN)).astype(np.float64)
    there = (rng.random((7, 4)) < 0.8).astype(np.float64)
    aim = rng.normal(size=(7, 4, bigru.HIDDEN))
    recurrent = net.side[0][1].astype(np.float64)
    net.side[0][1] = recurrent
    keep = []
    net._run(gates, there, recurrent, keep)
    dgates, dweights = bigru._back(net, 0, aim.astype(np.float32), keep)
    loss = lambda g, u: float((net._run(g, there, u) * aim).sum())
    for array, grad, which in ((gates, dgates, 0), (recurrent, dweights, 1)):
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in array.shape)
            step = np.zeros_like(array)
            step[at] = 1e-2
            pair = [(gates + s * step, recurrent) if which == 0 else (gates, recurrent + s * step) for s in (1, -1)]
            assert (loss(*pair[0]) - loss(*pair[1])) / 2e-2 == pytest.approx(grad[at], abs=2e-3)


def test_language_of_held_out_documents(spark):
    out = queries.op10_language_id(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas().merge(out, on="doc_id")
    held = docs[docs.held_out]
    assert len(out) == 1000 and (held.lang == held.lang_pred).mean() > 0.97 and docs.score.between(0, 1).all()


def test_language_of_odd_rows(spark):
    docs = edge.docs(spark)
    net = langid.fit(docs)
    out = langid.predict(docs, net).select("text", "language.lang", "language.score").collect()
    for r in out:
        lettered = bool(r["text"]) and any(c.isalpha() for c in r["text"])
        assert r["lang"] == ("en" if lettered else "und") and 0 <= r["score"] <= 1
    assert langid.fit(edge.empty(spark)) is None
    assert langid.predict(docs, None).where("language.lang <> 'und'").count() == 0
    assert langid.predict(edge.empty(spark), net).count() == 0


def corpus(spark, n=240):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(["ba", "ko", "ri", "su", "te", "mo", "la"], rng.integers(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.integers(20, 400))]
        if i % 3 == 0:
            for _ in range(1 + len(words) // 60):
                words[rng.integers(len(words))] = "grr" + word()
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_by_character_cues(spark):
    docs, labels = corpus(spark)
    net = toxicity.fit(docs.where("doc_id < 180"), labels.where("doc_id < 180"))
    held = toxicity.score(docs.where("doc_id >= 180"), net).join(labels, "doc_id").toPandas()
    assert ((held.toxicity >= 0.5) == (held.toxic == 1)).mean() > 0.9
    assert held[held.toxic == 1].toxicity.min() > held[held.toxic == 0].toxicity.median()


def test_toxicity_of_odd_rows(spark):
    docs = edge.docs(spark)
    labels = spark.createDataFrame([(7, 1), (9, 0), (9, None), (None, 1), (50, 1)], "doc_id long, toxic int")
    net = toxicity.fit(docs, labels)
    out = toxicity.score(docs, net).select("text", "toxicity").collect()
    assert len(out) == docs.count() and all(0 <= r["toxicity"] <= 1 for r in out)
    assert len({r["toxicity"] for r in out if not (r["text"] or "").strip(" \t\n")}) == 1
    one_label = toxicity.fit(docs, labels.where("toxic = 0"))
    kept = toxicity.keep_clean(docs, one_label)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    none = toxicity.fit(edge.empty(spark), labels.limit(0))
    assert toxicity.score(edge.empty(spark), none).count() == 0 and toxicity.keep_clean(docs, none).count() == docs.count()


def test_a_repeated_id_is_one_training_document(spark):
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(900))
    docs = spark.createDataFrame([(1, None)] + [(1, words(k)) for k in range(40)] + [(2, words(99))], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs.repartition(4), labels).collect()
    assert {r["id"] for r in rows} == {1, 2} and len(rows) <= 2 * toxicity.STRETCHES
    assert len({r["s"].split("x")[0] for r in rows if r["id"] == 1}) == 1


LARGE = "/root/testdata/sf0.1"


@pytest.mark.skipif(not pathlib.Path(LARGE).exists(), reason="no test data")
def test_toxicity_of_rows_kept_out_of_the_fit(spark):
    out = queries.op3_toxicity(spark, LARGE).where("held_out")
    held = out.join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").where("toxic IS NOT NULL").toPandas()
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert len(toxic) > 100 and len(clean) > 1000
    assert (toxic.predicted == 1).mean() >= 0.8 and (clean.predicted == 0).mean() >= 0.97
    better = (toxic.score.to_numpy()[:, None] > clean.score.to_numpy()[None]).mean()
    assert better > 0.94

"""Token sequences: equal to plain encoding, a bijection of slots, read back and resumed."""

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.llm import tokenorder as t
from tests.llm import edge

ODD = ["", "a", "  a b", "a  b", "a \nb", "x\n y", " lead", "trail ", "a  b", "a 　b", "tab\t x", "é ü  ", "a \x1c b",
       "don't 12 34  56", "\n", " ", "a\x85 b", "漢字 です。 ok", "x  y", "a​ b"]


@pytest.fixture(scope="module")
def tokenizer():
    return t.Tokenizer(t.read_ranks())


def test_batches_encode_as_single_texts(tokenizer):
    texts = ODD + [r[1] or "" for r in edge.rows()]
    ids, bounds = tokenizer.encode(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encoding.encode_ordinary(text)


def test_round_trip_and_resume(spark, tmp_path, tokenizer):
    docs = edge.docs(spark)
    layout = t.write_shards(docs, str(tmp_path / "s"), length=64, per_shard=50)
    shards = spark.read.parquet(str(tmp_path / "s")).orderBy("shard").collect()
    assert [r["shard"] for r in shards] == list(range(-(-layout.sequences // 50)))
    assert all(len(r["payload"]) == r["n_sequences"] * layout.stride and r["first_slot"] == 50 * r["shard"] for r in shards)
    assert all(r["n_sequences"] == 50 for r in shards[:-1])
    rows = t.ordered(docs, length=64, per_shard=50)[0].toPandas()
    assert sorted(rows.slot) == list(range(layout.sequences))
    by_slot = {s: bytes(x) for s, x in zip(rows.slot, rows.sequence)}
    for r in t.read_slots(spark, str(tmp_path / "s"), layout, 45, 160).collect():
        shard, offset = layout.place(r["slot"])
        assert bytes(r["tokens"]) == by_slot[r["slot"]] == bytes(shards[shard]["payload"][offset:offset + layout.stride])
    texts = sorted(r[1] or "" for r in edge.rows())
    back = []
    stored = t.ordered(docs.dropDuplicates(["doc_id", "text"]).where("doc_id is not null"), length=64, per_shard=50)[0].toPandas()
    for _, group in stored.sort_values("place").groupby("id"):
        ids = np.concatenate([np.frombuffer(bytes(x), "<u2") for x in group.sequence])
        n = group.n_tokens.iloc[0]
        back.append(tokenizer.decode(ids[:n]))
        assert (ids[n:] == t.END).all() and len(ids) > n
    assert sorted(back) == sorted({r[0]: r[1] or "" for r in edge.rows() if r[0] is not None}.values()) and set(back) <= set(texts)


def test_slots_follow_the_key(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    slots = lambda k: [r["slot"] for r in t.ordered(docs, key=k)[0].orderBy("id", "place").collect()]
    assert slots(1) == slots(1) != slots(2)
    assert slots(1) != sorted(slots(1))


def test_empty_table(spark, tmp_path):
    layout = t.write_shards(edge.empty(spark), str(tmp_path / "s"))
    assert layout.sequences == 0 and spark.read.parquet(str(tmp_path / "s")).count() == 0

"""Periodic runs against brute force over all periods."""

import hashlib
import pathlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import queries, runs
from tests.llm import edge

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least=12):
    """(start, length, period) of every run, by going through all periods from the smallest up."""
    found = {}
    for p in range(1, len(words)):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j - i + p >= least:
                found.setdefault((i, j + p), p)
            i = max(i + 1, j)
    return sorted(((a, b - a, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for start, length, period in found for k in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def odd_texts(seed, n=400):
    rng = random.Random(seed)
    for _ in range(n):
        size, letters = rng.randint(0, 90), "abcde"[:rng.choice([1, 2, 3, 5])]
        words = [rng.choice(letters) for _ in range(size)]
        if size and rng.random() < 0.5:
            a, p = rng.randrange(size), rng.randint(1, max(1, size // 3))
            words = [words[i if i < a else a + (i - a) % p] for i in range(size)]
        yield " ".join(words)


@pytest.mark.parametrize("least", [12, 2, 7])
def test_runs_are_those_of_brute_force(least):
    texts = list(odd_texts(least))
    found, out = runs.text_runs(pa.array(texts, pa.large_string()), least)
    for text, mine, short in zip(texts, found, out.to_pylist()):
        want = brute(text.split(), least)
        assert [tuple(r) for r in mine.tolist()] == want
        assert short == collapsed(text.split(), want)


def test_long_repeats_take_little_time():
    texts = ["a " * 50_000, "a b c " * 20_000, "x " + "a b " * 20_000 + "a c"]
    found, _ = runs.text_runs(pa.array(texts, pa.large_string()))
    assert [[tuple(r) for r in f.tolist()] for f in found] == [[(0, 50_000, 1)], [(0, 60_000, 3)], [(1, 40_001, 2)]]


def test_odd_rows(spark):
    docs = edge.docs(spark)
    out = runs.collapse_runs(docs, into="rank")
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    for row in out.select("text", "rank").collect():
        words = WORD.findall(row["text"] or "")
        # The long text of random words is checked by its collapsed length alone.
        want = brute(words) if len(words) < 5_000 else [tuple(r) for r in row["rank"]["runs"]]
        assert [tuple(r) for r in row["rank"]["runs"]] == want
        assert row["rank"]["collapsed"] == collapsed(words, want)
    assert runs.collapse_runs(edge.empty(spark)).count() == 0


def test_columns_with_dots_and_maps(spark):
    docs = spark.createDataFrame([(1, "a " * 20, {"k": 1})], "doc_id long, `the.text` string, m map<string,long>")
    row = runs.collapse_runs(docs, text_col="the.text").first()
    assert row["periodic"]["collapsed"] == "a" and row["m"] == {"k": 1}


@pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test data")
def test_query_is_that_of_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.length("text") < 12_000).collect()
    out = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    planted = 0
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            planted += 1
        want = brute(words)
        best = min(want, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = out[doc_id]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(want), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if want else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in want).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
    assert planted

"""Counts against plain Python, fences against sorted values."""

import math
import re
from collections import Counter

import pytest

from tallywatch.llm import quality
from tests.llm import edge

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.mark.parametrize("make", [edge.docs, lambda spark: spark.read.parquet(f"{SF}/documents.parquet")])
def test_counts(spark, make):
    docs = make(spark)
    want = Counter((r["doc_id"], *counted(r["text"])) for r in docs.collect())
    out = quality.judge(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out) == want
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_empty_table(spark):
    assert quality.judge(edge.empty(spark)).count() == 0


def prose(i, n=70):
    return " ".join(f"w{(i * 31 + k * 7) % 9973}x{k}" for k in range(n))


def test_fences_follow_their_group(spark):
    # Source b is full of symbols, source a is not; c is too small and falls back on its language.
    rows = [(i, prose(i), "en", "a") for i in range(150)]
    rows += [(1000 + i, prose(i).replace(" ", " # "), "en", "b") for i in range(150)]
    rows += [(2000, prose(5).replace("x", "##"), "en", "a"), (2001, prose(6).replace(" ", " # "), "en", "b")]
    rows += [(3000, prose(7), "de", "c"), (3001, prose(8), None, None)]
    out = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(out[i]["kept"] for i in (*range(150), *range(1000, 1150), 2001, 3000, 3001))
    assert not out[2000]["kept"]
    shares = sorted(out[i]["symbol_share"] for i in range(150)) + [out[2000]["symbol_share"]]
    high = sorted(shares)[math.ceil(0.75 * len(shares)) - 1]
    assert out[0]["max_symbol_share"] == high + quality.MEASURES["symbol_share"]


def test_sketches_merge(spark):
    judged = quality.shares(quality.measured(spark.read.parquet(f"{SF}/documents.parquet")))
    whole = quality.sketches(judged)
    halves = quality.sketches(judged.where("id % 2 = 0")).unionByName(quality.sketches(judged.where("id % 2 = 1")))
    rows = lambda s: sorted(map(tuple, quality.fences(s, ["lang"]).collect()))
    assert rows(whole) == rows(halves)

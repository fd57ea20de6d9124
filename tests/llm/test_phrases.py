"""Phrases by counting in circles against counting everything."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tallywatch.llm import phrases
from tallywatch.llm.words import extended
from tests.llm import edge


def all_counts(rows, longest=4):
    """(lang, words) to count, with (lang, None) for all words of a language."""
    out = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            out[lang, None] += len(words)
            for length in range(1, longest + 1):
                for i in range(len(words) - length + 1):
                    out[lang, " ".join(words[i:i + length])] += 1
    return out


def brute(rows, least, top):
    counts = all_counts(rows)
    found = {}
    for (lang, phrase), a in counts.items():
        if phrase is None or a < least or len(phrase.split(" ")) < 2:
            continue
        inside = any(lang == other and longer is not None and len(longer) > len(phrase) and f" {phrase} " in f" {longer} "
                     and n >= least and 100 * n >= 80 * a for (other, longer), n in counts.items())
        if inside:
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, counts[lang, None], -score)
            for lang, rows_ in found.items()
            for rank, (score, a, p, left, right) in enumerate(sorted(rows_)[:top], 1)}


def made_up(seed=5, n=120):
    rng = random.Random(seed)
    stock = ["new york city hall", "ad hoc", "à la carte", "São Paulo", "of the", "x\ty z", "one, two; three"]
    out = []
    for i in range(n):
        words = [rng.choice(["a", "B", "of", "the", "é", *stock]) for _ in range(rng.randint(0, 40))]
        out.append((rng.choice([" ", "  ", " ", ". "]).join(words), rng.choice(["en", "en", None, "de"])))
    return out + [(None, "en"), ("", None), ("only once here", "xx")] + [("copy of a copy", "en")] * 40


@pytest.mark.parametrize("shards,bits", [(3, 25), (1, 25), (5, 25), (3, 8)])
def test_collocations_are_those_of_full_counts(spark, shards, bits):
    rows = made_up()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    out = phrases.collocations(docs, least=12, top=15, shards=shards, bits=bits)
    assert {tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()} == brute(rows, 12, 15)


def test_counts_of_every_length(spark):
    rows = made_up(6, 60)
    out = phrases.phrase_counts(spark.createDataFrame(rows, "text string, lang string"), least=9, bits=12)
    got = {(r["lang"], r["phrase"]): r["n"] for r in out.collect()}
    assert got == {k: n for k, n in all_counts(rows).items() if n >= 9 or k[1] is None}


def test_words_across_texts_do_not_touch(spark):
    rows = [("alpha", "en"), ("beta", "en")] * 50
    assert phrases.collocations(spark.createDataFrame(rows, "text string, lang string").coalesce(1), least=5).count() == 0


def test_products_beyond_64_bits(spark):
    counts = [("en", 0, None, 9 * 10**18), ("en", 1, "a", 4 * 10**18), ("en", 1, "b", 4 * 10**18), ("en", 2, "a b", 3 * 10**18)]
    frame = spark.createDataFrame(counts, "lang string, length int, phrase string, n long")
    original = phrases.phrase_counts
    phrases.phrase_counts = lambda *args: frame
    try:
        row = phrases.collocations(frame.selectExpr("phrase AS text", "lang")).first()
    finally:
        phrases.phrase_counts = original
    assert (row["score"], row["a"], row["l"], row["r"], row["n"]) == (750_000, 3 * 10**18, 4 * 10**18, 4 * 10**18, 9 * 10**18)


def test_odd_rows(spark):
    rows = [(r[1], r[2]) for r in edge.rows()]
    out = phrases.collocations(edge.docs(spark), least=30)
    want = brute(rows, 30, 2000)
    assert {tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()} == want and want
    assert phrases.collocations(edge.empty(spark)).count() == 0


def test_columns_with_dots_and_maps(spark):
    docs = spark.createDataFrame([("a b", "en", {"k": 1})] * 40, "`the.text` string, `the.lang` string, m map<string,long>")
    row = phrases.collocations(docs, "the.text", "the.lang").first()
    assert (row["phrase"], row["a"], row["l"], row["r"], row["n"], row["score"]) == ("a b", 40, 40, 40, 80, 1_000_000)


def compared(spark, rows, least, **kw):
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    counts = phrases.phrase_counts(docs, least=least, **kw)
    assert {(r["lang"], r["phrase"]): r["n"] for r in counts.collect()} == {
        k: n for k, n in all_counts(rows).items() if n >= least or k[1] is None}
    out = phrases.collocations(docs, least=least, top=2000, **kw)
    got = [tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, least, 2000)


def test_a_phrase_whose_part_shares_its_bit_with_a_word(spark):
    bits = 16
    stock = [f"w{i}" for i in range(400_000)]
    x, y = phrases._Tokens(pa.array(["x y"]), pa.array(["en"])).hash
    pair = extended(np.array([x]), np.array([y]))[0] >> np.uint64(64 - bits)
    hashes = phrases._Tokens(pa.array([" ".join(stock)]), pa.array(["en"])).hash >> np.uint64(64 - bits)
    double = stock[int(np.flatnonzero(hashes == pair)[0])]
    # Rows go to the three shards in turn. The bit of "x y" is set by the first, "y z" reaches six in the second, "x" in the third.
    first = " ".join(["x y z", *["y z."] * 9, *[double + "."] * 9])
    rows = [(first, "en"), ("x y z. x y z." + "y z." * 9, "en"), ("x y z. x y z. x y z", "en")]
    compared(spark, rows, 6, bits=bits)


def test_languages_and_words_with_zero_bytes(spark):
    rows = [("b\x00c d", "a")] * 7 + [("c d", "a\x00b")] * 5 + [("c", "a\x00b")] * 9
    compared(spark, rows, 5)


def test_memory_of_a_scan_does_not_follow_the_batch():
    texts = pa.array(["some words of a text, and more of them "] * 500_000)
    batch = pa.RecordBatch.from_arrays([texts, pa.array(["en"] * len(texts))], ["text", "lang"])
    tracemalloc.start()
    words = sum(len(tokens.hash) for tokens in phrases._each(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words == 9 * len(texts) and peak < 60_000_000


def test_blocks_give_back_values_and_counts():
    low = np.sort(np.random.default_rng(1).choice(1 << 32, 5000, replace=False)).astype(np.uint32)
    n = np.arange(5000, dtype=np.uint64) % 300
    both = phrases._unblock(phrases._block(low, n))
    assert (both >> np.uint64(32) == low).all() and (both & np.uint64(0xFFFFFFFF) == n).all()


def test_phrases_kept_over_several_batches():
    rows = made_up(7, 40)
    kept = phrases._Kept()
    for part in (rows[:25], rows[25:]):
        texts, langs = zip(*part)
        kept.count(phrases._Tokens(pc.fill_null(pa.array(texts, pa.string()), ""), pc.fill_null(pa.array(langs, pa.string()), "und")),
                   np.full(1 << 4, 2**64 - 1, dtype=np.uint64), 4)
    blocks = kept.blocks(3)
    assert len(set(blocks["part"].to_pylist())) > 1
    table = phrases._summed([pa.ipc.open_stream(block.as_buffer()).read_all() for block in blocks["block"]])
    got = {(r["lang"], r["phrase"] and r["phrase"].decode()): r["n"] for r in table.to_pylist()}
    assert len(got) == len(table) and got == all_counts(rows) | {key: 0 for key in got if key[1] is None and got[key] == 0}

"""Surrogates: nothing left, one for each entity, distinct, in layout."""

import re

from pyspark.sql import functions as F

from tallywatch.llm import surrogates
from tests.llm import edge

ROWS = [
    (1, "Mail Anna.14@mail9.example.com or ANNA.14@MAIL9.EXAMPLE.COM, call +1 (559) 555-3817, (559) 555-3817."),
    (2, "Mr. John Smith met Mrs Anna Smith. Mr Smith left. Госпожа Анна Иванова und Frau Müller, Κύριος Νίκος Παππάς"),
    (3, "4111111111111111 4111-1111-1111-1111 10.0.0.1 123-45-6789"),
    (4, 'TOKEN = "9999A9ECF9C9B99FE9999999B9B99BC999E9999B"!! ñez.9@mail1.example.com###'),
    (5, "version 2.0 in 2024, 12 items of 3456"),
    (6, "again 559-555-3817 and anna.14@mail9.example.com"),
]


def run(spark, rows=ROWS, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.replace_entities(df, **options).collect()}


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(values)) % 10 == 0


def test_types(spark):
    out = run(spark)
    mails = re.findall(r"[^\s,#]+@[^\s,#]+", out[1][0] + " " + out[6][0])
    assert len({m.lower() for m in mails}) == 1 and mails[1].isupper() and mails[0].endswith(".example.org")
    assert re.match(r"[a-z]{4}\.\d\d@", mails[0]) and not mails[0].startswith("anna")
    phones = re.findall(r"\+1 \((\d{3})\) (\d{3})-(\d{4}), \((\d{3})\) (\d{3})-(\d{4})", out[1][0])[0]
    assert phones[:3] == phones[3:] and "-".join(phones[:3]) in out[6][0] and phones[:3] != ("559", "555", "3817")
    names = re.match(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+)\. Mr (\w+) left\. Госпожа (\w+) (\w+) und Frau (\w+), Κύριος (\w+) (\w+)$", out[2][0]).groups()
    john, smith, anna = names[0], names[1], names[2]
    assert smith == names[3] == names[4] != "Smith"
    assert john.endswith("ren") and anna.endswith("na") and all(n[0].isupper() for n in names)
    assert re.fullmatch("[А-Яа-я]+", names[5]) and names[5].endswith("на") and re.fullmatch("[Α-Ωα-ως]+", names[8])
    card, dashed, address, ssn = out[3][0].split(" ")
    assert dashed.replace("-", "") == card != "4111111111111111" and card[0] == "4" and luhn(card)
    assert all(0 < int(x) < 255 for x in address.split(".")) and re.fullmatch(r"\d{3}-\d{2}-\d{4}", ssn)
    assert re.search(r'TOKEN = "[0-9A-F]{40}"!! \w{3}\.\d@\w+\.example\.org###$', out[4][0])
    assert out[5] == (ROWS[4][1], 0)
    assert [out[i][1] for i in (1, 2, 3, 4, 6)] == [4, 6, 4, 2, 2]


def test_keyed_and_repeatable(spark):
    assert run(spark) == run(spark)
    assert run(spark, key="another")[1] != run(spark)[1]


def test_distinct_entities_stay_distinct(spark):
    # Few surrogates of this type: two-letter local parts, many of them.
    rows = [(i, f"Mrs {chr(65 + i % 26)}{chr(97 + i // 26)}a x{i % 7}{i // 7 % 10}@a.example.com 10.0.{i // 200}.{i % 200 + 1}") for i in range(400)]
    out = run(spark, rows)
    maps = {}
    for i, text in rows:
        for a, b in zip(text.split(" ")[1:], out[i][0].split(" ")[1:]):
            assert maps.setdefault(a, b) == b and a != b
    assert len(set(maps.values())) == len(maps)


def test_collisions_are_drawn_again(spark, monkeypatch):
    plain = surrogates.surrogate

    def clumsy(kind, canonical, attempt, key=surrogates.KEY):
        return F.when(attempt == 0, F.lit("10.0.0.7")).otherwise(plain(kind, canonical, attempt, key))

    monkeypatch.setattr(surrogates, "surrogate", clumsy)
    entities = spark.createDataFrame([("address", f"10.0.0.{i}", 1) for i in range(1, 9)], "type string, canonical string, n long")
    got = [r["surrogate"] for r in surrogates.assign_surrogates(entities).collect()]
    assert len(set(got)) == 8 and not set(got) & {f"10.0.0.{i}" for i in range(1, 9)}


def test_odd_rows(spark):
    docs = edge.docs(spark)
    out = surrogates.replace_entities(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    assert sorted(str(r["text"]) for r in out.select("text").collect()) == sorted(str(t[1]) for t in edge.rows())
    assert surrogates.replace_entities(edge.empty(spark)).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    both = docs.join(surrogates.replace_entities(docs).withColumnRenamed("text", "new"), "doc_id").collect()
    pattern = re.compile(r"\S+@\S+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}|[0-9a-fA-F]{40}")
    maps = {}
    for r in both:
        old, new = pattern.findall(r["text"]), pattern.findall(r["new"])
        assert len(old) == len(new) and (old or r["text"] == r["new"])
        assert all(maps.setdefault(a.lower(), b.lower()) == b.lower() and a != b for a, b in zip(old, new))
    assert maps and len(set(maps.values())) == len(maps)

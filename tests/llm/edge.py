"""Documents with everything that can be odd: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, fp long, id string, "
          "rank int, size long, shard string, _row long, row long, word string, part int, n_entities string, "
          "language string, toxicity string, at int, type string")
EXTRA = (0.5, 7, "x", 1, 2, "s", 3, 4, "w", 5, "e", "l", "t", 6, "k")


def rows():
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice(["ba", "ko", "ri", "su", "te"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    texts = [None, "", " \t\n ", "one", "one two", "é ü 漢字", "\x1c \x85 　", prose(30_000), "a " * 3_000, prose(80), prose(80)]
    out = []
    for i, text in enumerate(texts):
        out.append((i, text, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", len(text or ""), *EXTRA))
    out.append((None, prose(60), None, None, None, *([None] * len(EXTRA))))
    out.append((None, None, None, None, None, *([None] * len(EXTRA))))
    return out + out[8:11] + out[9:10]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

"""Quality rules with thresholds that follow the data.

Six counts are taken of every text: words, code points in words, symbols, lines that
repeat an earlier one, words inside repeated three-word windows, and letters in upper
case. Four shares made of them are judged against fences learned per language and source.

The sketch is a histogram per (language, source, measure) whose buckets are 1/1000 wide,
so two sketches merge by adding counts, a quantile is exact to a thousandth, and nothing
depends on partitioning. Shares lie between 0 and 1, hence at most 1001 buckets each. A
group with fewer than ``least_docs`` documents is judged by the sketch merged over its
language, or failing that over all documents. The fence of a measure is its upper
quartile plus ``reach`` times the distance between median and upper quartile, and at
least the measure's slack above the upper quartile, so that groups without spread are not
cut at their common value.

Sketches learn from documents that pass the base rule. Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.joins import lookup
from tallywatch.llm.words import let, words_of
from tallywatch.sources.scratch import materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIDDLE, UPPER = 0.5, 0.75
REACH = 3.0
LEAST_DOCS = 100
GRAIN = 1000
#: The judged shares, and how far above the upper quartile a fence lies at least, in
#: thousandths: a few symbols or one repeated line are no fault in any text.
MEASURES = {"symbol_share": 50, "dup_line_share": 500, "repeat_share": 400, "upper_share": 300}


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of ``window`` words that occur twice or more, first ones included.

    Windows are compared by a 64-bit hash. Most texts have no equal windows, which one
    hash set shows; only the others have their windows sorted.
    """

    def covered(w: Column) -> Column:
        last = F.size(w) - window
        hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

        def of_hashes(h: Column) -> Column:
            ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

            def places(s: Column) -> Column:
                same = lambda x, i, at: F.coalesce(F.get(s, i + at)["h"] == x["h"], F.lit(False))
                twice = F.filter(s, lambda x, i: same(x, i, -1) | same(x, i, 1))
                return F.array_sort(F.transform(twice, lambda x: x["i"]))

            start = F.struct(F.lit(-window).alias("at"), F.lit(0).alias("n"))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(F.aggregate(
                let(ordered, places), start,
                lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(window), i - acc["at"])).alias("n")),
                lambda acc: acc["n"]))

        return F.when(last < 0, 0).otherwise(let(hashes, of_hashes))

    return let(words, covered)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """(id, lang, source) and the counts of every text; a null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    squeezed = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    lines = F.size(F.split(text, "\n"))
    return docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        let(words_of(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(squeezed).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines(text).cast("long").alias("n_dup_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))).cast("long").alias("n_upper"),
        lines.cast("long").alias("n_lines"),
    ).select("*", "w.*").drop("w")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _per_mille(part: str, whole: str) -> Column:
    whole = F.col(whole)
    return F.when(whole == 0, 0).otherwise(F.call_function("div", F.lit(GRAIN) * F.col(part), F.greatest(whole, F.lit(1))))


def shares(counts: DataFrame) -> DataFrame:
    """Add the judged shares in thousandths, rounded down, and ``base_failed``."""
    pairs = (("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_upper", "word_chars"))
    return counts.withColumns({m: _per_mille(*p).cast("int") for m, p in zip(MEASURES, pairs)}).withColumn(
        "base_failed", base_failed())


def sketches(judged: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the mergeable sketch of every group."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("bucket")) for m in MEASURES]))
    return judged.where(~F.col("base_failed")).select("lang", "source", cells.alias("c")).groupBy(
        "lang", "source", "c.measure", "c.bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, level: list[str], reach: float = REACH) -> DataFrame:
    """Fence of every measure for each group of ``level``, with the group's number of documents.

    A quantile is the first bucket whose running count reaches that share of the group.
    """
    merged = sketch.groupBy(*level, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*level, "measure")
    ranked = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("docs", F.sum("n").over(group))
    quantile = lambda q: F.min(F.when(F.col("upto") >= F.lit(q) * F.col("docs"), F.col("bucket")))
    low, high = F.col("low"), F.col("high")
    slack = F.element_at(F.create_map(*[F.lit(x) for pair in MEASURES.items() for x in pair]), F.col("measure"))
    fence = high + F.greatest(slack.cast("double"), F.lit(float(reach)) * (high - low))
    per_measure = ranked.groupBy(*level, "measure").agg(
        quantile(MIDDLE).alias("low"), quantile(UPPER).alias("high"), F.first("docs").alias("docs"))
    return per_measure.withColumn("fence", fence).groupBy(*level).agg(
        F.max("docs").alias("docs"), *[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(m) for m in MEASURES])


def thresholds(sketch: DataFrame, least_docs: int = LEAST_DOCS, reach: float = REACH) -> DataFrame:
    """One row per (lang, source) with the fence of every measure, from the smallest group that is large enough."""
    own = fences(sketch, ["lang", "source"], reach)
    by_lang = fences(sketch, ["lang"], reach)
    overall = fences(sketch, [], reach)
    table = own.alias("o").join(by_lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang"))).join(
        F.broadcast(overall.alias("a")), F.lit(True))  # one row
    pick = lambda m: F.when(F.col("o.docs") >= least_docs, F.col(f"o.{m}")).when(
        F.col("l.docs") >= least_docs, F.col(f"l.{m}")).otherwise(F.col(f"a.{m}"))
    return table.select("o.lang", "o.source", *[pick(m).alias(f"max_{m}") for m in MEASURES])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", least_docs: int = LEAST_DOCS, reach: float = REACH) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    A document is kept if it passes the base rule and none of its shares lies above its
    group's fence. Null texts count as empty and fail the base rule. A null language or
    source is a group like any other. A group none of whose documents passes the base rule
    has no fence and needs none. Repeated rows and null ids are judged like others; other
    columns are not read; an empty table gives no rows.
    """
    judged = materialise(shares(measured(docs, id_col, text_col, lang_col, source_col)), "measured")
    limits = materialise(thresholds(materialise(sketches(judged), "sketches"), least_docs, reach), "thresholds")
    # One text key for both columns, nulls told apart from every text.
    key = F.to_json(F.struct("lang", "source"))
    table = limits.select(key.alias("_group"), *[f"max_{m}" for m in MEASURES])
    found = lookup(judged.withColumn("_group", key), "_group", table)
    within = F.lit(True)
    for m in MEASURES:
        within = within & (F.col(m) <= F.coalesce(F.col(f"max_{m}"), F.lit(float(GRAIN))))
    return found.withColumn("kept", ~F.col("base_failed") & within).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", *MEASURES, *[F.col(f"max_{m}") for m in MEASURES])


def keep_good(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document is kept; rows with one id share a verdict, the strictest."""
    bad = judge(docs, id_col, **options).where(~F.col("kept")).select(F.col(id_col).alias("_bad")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]), "left_anti")


def quality_sql(table: str = "documents") -> str:
    """The same verdicts in DuckDB, for tables whose ids are distinct."""
    share = "CASE WHEN {1} = 0 THEN 0 ELSE {2} * {0} // {1} END"
    parts = (("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_upper", "word_chars"))
    shares = ", ".join(f"{share.format(a, b, GRAIN)} AS {m}" for m, (a, b) in zip(MEASURES, parts))
    cells = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS bucket FROM judged WHERE NOT base_failed" for m in MEASURES)
    slack = "CASE measure " + " ".join(f"WHEN '{m}' THEN {s}" for m, s in MEASURES.items()) + " END"

    def level(name: str, group: str) -> str:
        by = f"{group}, measure" if group else "measure"
        out = f"{group}, " if group else ""
        picked = ", ".join(f"max(CASE WHEN measure = '{m}' THEN fence END) AS {m}" for m in MEASURES)
        return f"""
{name}_ranked AS (SELECT {by}, bucket, count(*) OVER (PARTITION BY {by}) AS docs,
  count(*) OVER (PARTITION BY {by} ORDER BY bucket) AS upto FROM cells),
{name}_q AS (SELECT {by}, max(docs) AS docs, min(bucket) FILTER (WHERE upto >= {MIDDLE} * docs) AS low,
  min(bucket) FILTER (WHERE upto >= {UPPER} * docs) AS high FROM {name}_ranked GROUP BY {by}),
{name} AS (SELECT {out}max(docs) AS docs, {picked}
  FROM (SELECT *, high + greatest(CAST({slack} AS DOUBLE), {REACH} * (high - low)) AS fence FROM {name}_q)
  {"GROUP BY " + group if group else ""})"""

    limits = ", ".join(
        f"CASE WHEN o.docs >= {LEAST_DOCS} THEN o.{m} WHEN l.docs >= {LEAST_DOCS} THEN l.{m} ELSE a.{m} END AS max_{m}" for m in MEASURES)
    within = " AND ".join(f"{m} <= coalesce(max_{m}, {GRAIN})" for m in MEASURES)
    return f"""
WITH texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM {table}),
grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM texts, unnest(range(1, len(words) - 1)) AS t(i)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
counted AS (
  SELECT texts.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
              - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
         length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS n_upper
  FROM texts LEFT JOIN covered ON covered.doc_id = texts.doc_id),
judged AS (
  SELECT *, {shares}, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
cells AS ({cells}),{level("own", "lang, source")},{level("by_lang", "lang")},{level("overall", "")},
limits AS (
  SELECT o.lang, o.source, {limits} FROM own o JOIN by_lang l ON l.lang IS NOT DISTINCT FROM o.lang, overall a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {within} AS kept,
       {", ".join(f"CAST({m} AS INTEGER) AS {m}" for m in MEASURES)}, {", ".join(f"max_{m}" for m in MEASURES)}
FROM judged j LEFT JOIN limits t ON t.lang IS NOT DISTINCT FROM j.lang AND t.source IS NOT DISTINCT FROM j.source
"""

"""The registered queries of this subpackage, one for each operator, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import decontaminate, jaccard, langid, lm, mixing, phrases, quality, runs, sharding, simhash, surrogates, tokenorder, toxicity
from tallywatch.llm.words import bucket_of, let, load, words_of


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rule and learned fences, for every document."""
    return quality.judge(load(spark, sf_dir, "documents"))


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice and add-one likelihood of every document, learnt from those that are not held out."""
    docs = load(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 7) == 2
    model = lm.fit(docs, ~held_out)
    return lm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"),
        "base_score", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled ones that are not held out."""
    docs = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels")
    held_out = bucket_of(F.col("doc_id"), 3) == 1
    net = toxicity.fit(docs.where(~held_out), labels.where(~held_out))
    scored = toxicity.score(docs.select("doc_id", "text"), net, into="score")
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    placed = sharding.assign_shards(load(spark, sf_dir, "documents"))
    return placed.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes")


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shard of the token sequences of all documents in training order, its payload as a digest."""
    sequences, layout = tokenorder.ordered(load(spark, sf_dir, "documents"))
    return tokenorder.shards(sequences, layout).select("shard", "first_slot", "n_sequences", F.octet_length("payload").cast("long").alias("n_bytes"),
                          F.md5("payload").alias("payload_md5"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the weighted mix takes from every document."""
    plan = mixing.mix(load(spark, sf_dir, "documents"))
    return mixing.document_totals(plan).withColumnRenamed("id", "doc_id")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data."""
    return surrogates.replace_entities(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, all documents against all items."""
    docs = load(spark, sf_dir, "documents")
    blocks = decontaminate.fit(docs, load(spark, sf_dir, "benchmark"))
    return decontaminate.matches(docs, blocks)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from those that are not held out."""
    docs = load(spark, sf_dir, "documents")
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    net = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document by the Jaccard similarity of word shingles."""
    return jaccard.shingle_classes(load(spark, sf_dir, "documents"))


def planted_repeats(doc_id: Column, text: Column) -> Column:
    """The text; for one id in ten, by its crc32 h, the words from a on become the first p of them over and over.

    g = floor(h / 10), n words, a = g mod n, p = 1 + floor((n - a) / (3 + g mod 8)). A null id counts as empty text.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        a = F.pmod(g, F.size(words)).cast("int")
        p = 1 + F.floor((F.size(words) - a) / (3 + F.pmod(g, F.lit(8)))).cast("int")
        return F.array_join(F.transform(words, lambda word, i: F.when(i < a, word).otherwise(F.get(words, a + (i - a) % p))), " ")

    return F.when((h % 10 == 0) & (F.size(words_of(text)) > 0), let(words_of(text), repeated)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, planted ones included, and the text without the repeats, as digests."""
    docs = load(spark, sf_dir, "documents")
    planted = docs.select("doc_id", planted_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.collapse_runs(planted, into="periodic")
    listed = found.select("doc_id", F.col("periodic.runs").alias("runs"), F.sha2(F.encode("periodic.collapsed", "UTF-8"), 256).alias("collapsed_sha256"))
    return listed.withColumn("longest", runs.longest_run(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("(1000 * longest.length) div longest.period").alias("exponent_milli"),
        F.sha2(F.encode(runs.runs_text(F.col("runs")), "UTF-8"), 256).alias("runs_sha256"), "collapsed_sha256")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to four words of every language, counted over all documents."""
    return phrases.collocations(load(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules, "op2_lattice_lm": op2_lattice_lm, "op3_toxicity": op3_toxicity, "op4_hash_shards": op4_hash_shards,
    "op5_training_order": op5_training_order, "op6_simhash_dedup": op6_simhash_dedup, "op7_mix_sources": op7_mix_sources,
    "op8_surrogates": op8_surrogates, "op9_latent_decontamination": op9_latent_decontamination, "op10_language_id": op10_language_id,
    "op11_jaccard_join": op11_jaccard_join, "op12_periodic_runs": op12_periodic_runs, "op13_phrase_collocations": op13_phrase_collocations,
}
ORACLE: dict[str, str] = {"op1_quality_rules": quality.quality_sql(), "op4_hash_shards": sharding.shards_sql(),
                          "op13_phrase_collocations": phrases.collocations_sql()}

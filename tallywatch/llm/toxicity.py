"""Toxicity of a text: the likeliest of all its overlapping windows, by the network in ``bigru``.

The network is fitted on the driver from a bounded sample: at most ``per_label`` labelled
documents of either label and ``STRETCHES`` windows of each, cut out before anything
reaches the driver. It takes about five megabytes, whatever the data. Scoring reads every
word of every text, needs no shuffle, and each task holds one batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import bigru
from tallywatch.llm.labelled import bounded_sample
from tallywatch.llm.words import byte_rows, coded_words, let, pieces, words_of

PER_LABEL = 1500
STRETCHES = 12
THRESHOLD = 0.7
PIECE = 3_000_000


def stretches(text: Column, key: Column, n: int = STRETCHES, length: int = bigru.WINDOW) -> Column:
    """``n`` runs of ``length`` words at places named by a hash; of a short text the whole text once."""

    def cut(words: Column) -> Column:
        room = F.greatest(F.size(words) - length, F.lit(0)) + 1
        runs = F.array(*[
            F.array_join(F.slice(words, (F.pmod(F.xxhash64(key, F.lit(i)), room) + 1).cast("int"), length), " ")
            for i in range(n)])
        return F.array_distinct(runs)

    return let(words_of(text), cut)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", per_label: int = PER_LABEL) -> DataFrame:
    """(id, label, s): the stretches of at most ``per_label`` documents of either label.

    Of rows with one id a single one counts, named by a hash of its text, null texts last.
    """
    marks = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    chosen = bounded_sample(marks, "label", "id", per_label)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), "id").select(
        "id", "label", stretches(F.col("text"), F.col("id")).alias("runs"),
        F.struct(F.col("text").isNull(), F.xxhash64("text")).alias("order"))
    # One row for each id, so at most per_label rows of either label, before runs become rows.
    return found.groupBy("id", "label").agg(F.min_by("runs", "order").alias("runs")).select(
        "id", "label", F.explode("runs").alias("s"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_label: int = PER_LABEL) -> bigru.BiGru:
    """The network. Labels other than 0 and 1, null included, are left out, as are documents
    without a label; an id labelled more than once counts with its largest label."""
    rows = training_rows(docs, labels, id_col, text_col, label_col, per_label).collect()
    rows = sorted((r["id"], r["label"], r["s"]) for r in rows)
    ids = sorted({r[0] for r in rows})
    y = np.zeros(len(ids), dtype=np.int64)
    spot = {k: i for i, k in enumerate(ids)}
    for k, label, _ in rows:
        y[spot[k]] = label
    at, codes, distinct = coded_words(pa.array([r[2] for r in rows], pa.large_string()))
    windows, piece = bigru.windows_of(at, codes, len(distinct))
    owner = np.array([spot[r[0]] for r in rows], dtype=np.int64)[piece]
    return bigru.train(*byte_rows(distinct), windows, owner, y)


def toxic_share(text: Column, net: bigru.BiGru, spark: SparkSession) -> Column:
    """Between 0 and 1, from the likeliest window of each text.

    Null and empty texts, and texts of
    white space, have one window without words and get the score of that.
    """
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def likeliest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = shared.value
        for batch in batches:
            parts = []
            for texts in pieces(batch, PIECE):
                bounds, codes, distinct = coded_words(texts)
                tables = net.tables(net.inputs(*byte_rows(distinct)))
                windows, owner = bigru.windows_of(bounds, codes, len(distinct))
                p = net.probabilities(tables, windows)
                parts.append(np.maximum.reduceat(p, np.searchsorted(owner, np.arange(len(texts)))))
            yield pa.array(np.concatenate(parts).astype(np.float64) if parts else [], pa.float64())

    return likeliest(text)


def score(docs: DataFrame, net: bigru.BiGru, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a double column ``into``; a column of that name is replaced.

    Repeated rows get equal scores; other columns are kept as they are.
    """
    return docs.withColumn(into, toxic_share(F.col(text_col), net, docs.sparkSession))


def keep_clean(docs: DataFrame, net: bigru.BiGru, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns."""
    return docs.where(toxic_share(F.col(text_col), net, docs.sparkSession) < threshold)

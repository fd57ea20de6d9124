"""Language of a text by a byte convolutional network over fixed-length windows.

The network is fitted on the driver from a bounded sample of labelled rows: at most
``per_label`` documents of a language and ``SNIPPETS`` stretches of each. It is a few
kilobytes, whatever the data. Every window of every whole text is then classified; a
document's probabilities are the mean over its windows, weighted by their bytes that are
no white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm import byteconv
from tallywatch.llm.labelled import bounded_sample
from tallywatch.llm.words import byte_rows, pieces

PER_LABEL = 600
SNIPPETS = 3
SNIPPET_CHARS = 300
PIECE = 2_000_000
UNDETERMINED = "und"


def snippets(text: Column, key: Column, n: int = SNIPPETS, length: int = SNIPPET_CHARS) -> Column:
    """``n`` stretches of a text at places named by a hash."""
    room = F.greatest(F.length(text) - length, F.lit(0)) + 1
    return F.array(*[F.substr(text, (F.pmod(F.xxhash64(key, F.lit(i)), room) + 1).cast("int"), F.lit(length)) for i in range(n)])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_label: int = PER_LABEL) -> byteconv.ByteConv | None:
    """The network, or None if no row has both a text with a letter and a language."""
    usable = labelled.where(F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sample = bounded_sample(usable, "lang", "id", per_label)
    rows = sample.select("lang", F.explode(snippets(F.col("text"), F.col("id"))).alias("s")).collect()
    if not rows:
        return None
    rows = sorted((r["lang"], r["s"]) for r in rows)
    labels = sorted({r[0] for r in rows})
    data, bounds = byte_rows(pa.array([r[1] for r in rows], pa.large_string()))
    windows, owner = byteconv.windows_of(data, bounds)
    y = np.array([labels.index(r[0]) for r in rows])[owner]
    filled = (windows != 0).sum(axis=1) > byteconv.REACH
    return byteconv.train(windows[filled], y[filled], labels)


def predict(docs: DataFrame, net: byteconv.ByteConv | None, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into`` (lang, score); a column of that name is replaced.

    Null texts, empty texts and texts without a letter get ``und`` and score 0, as does
    every text if there is no network. Ties go to the language first in code-point order.
    Repeated rows get equal results; other columns are kept as they are.
    """
    if net is None:
        return docs.withColumn(into, F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score")))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("struct<lang string, score double>")
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = shared.value
        for batch in batches:
            langs, scores = [], []
            for texts in pieces(batch, PIECE):
                lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                windows, owner = byteconv.windows_of(*byte_rows(texts))
                weight = ((windows > 32) | (windows == 0)).sum(axis=1) - (windows == 0).sum(axis=1) + 1e-3
                p = net.probabilities(windows) * weight[:, None]
                total = np.add.reduceat(p, np.searchsorted(owner, np.arange(len(texts))), axis=0)
                total /= total.sum(axis=1, keepdims=True)
                best = total.argmax(axis=1)
                langs += [net.labels[k] if ok else UNDETERMINED for k, ok in zip(best, lettered)]
                scores.append(np.where(lettered, total[np.arange(len(texts)), best], 0.0))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                ["lang", "score"])

    return docs.withColumn(into, classify(F.col(text_col)))

"""Likelihood of texts under a subword lattice over an existing vocabulary.

The vocabulary file names the pieces and their scores; no tokenizer is trained. Scores
that are log probabilities are used as they are. Scores that are merge ranks stand for
weights by Zipf's law, 1 / (rank + 2.7). One pass of expectation over all training words
then adds how often each piece is used in the corpus, counted over all cuts of every
word by their share, to these scores as a prior.

A word's probability is the sum over all cuts of the product of the pieces' weights, by
forward recursion (``lattice``). A word that the training documents hold is one more arc
from its beginning to its end: as in Witten and Bell's rule it has the weight c / (N + V),
and the pieces share the rest, V / (N + V), with c the word's count, N all training tokens
and V the distinct ones. Pieces do not cross words, so a text's probability is the product
over its words and of that of the end of the text.

Words are counted in tasks and merged by Spark; every distinct word is cut up once,
however often it occurs. The ``HEAD`` most frequent words are broadcast, a number that
does not grow; the other words of a text, each of them rare, are joined with the table
of all words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.lattice import LONGEST, Lattice
from tallywatch.llm.words import byte_rows, coded_words, pieces
from tallywatch.sources.scratch import materialise

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 100_000
#: The prior counts as much as so many pieces of text.
PRIOR = 1000.0
PIECE = 4_000_000
LOG10 = math.log(10.0)


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """The pieces of a SentencePiece model as bytes, a blank for the mark of a word's beginning, and log weights.

    The last weight is that of the end of a text. Control pieces, pieces with a mark
    inside and pieces longer than the lattice reads are left out. Bytes that are pieces of
    their own add to the character they spell; bytes the file lacks get the least weight.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    normal = [i for i in range(size) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    scores = np.array([model.get_score(i) for i in normal])
    ranks = bool((scores == np.round(scores)).all())
    weigh = (lambda s: 1.0 / (2.7 - s)) if ranks else math.exp
    weights: dict[bytes, float] = {}
    for i, s in zip(normal, scores):
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if piece and len(piece) <= LONGEST and b" " not in piece[1:] and s > -1e8:
            weights[piece] = weights.get(piece, 0.0) + weigh(float(s))
    least = min(weights.values(), default=1.0)
    for b in range(256):
        weights[bytes([b])] = weights.get(bytes([b]), 0.0) + least
    ordered = sorted(weights)
    w = np.array([weights[p] for p in ordered] + [np.mean(list(weights.values()))])
    return ordered, np.log(w / w.sum())


@dataclass(frozen=True)
class Model:
    """``words``: (word, c, base, score) with natural logs, for every word of the corpus; ``head``: the
    frequent ones, as sorted arrays; ``end``: (base, score) of the end; ``n`` and ``v``: training tokens,
    and distinct ones."""

    words: DataFrame
    head: pd.DataFrame
    end: tuple[float, float]
    end_known: bool
    n: int
    v: int


def word_counts(docs: DataFrame, text_col: str, trained: Column) -> DataFrame:
    """(word, c, n): every distinct word, A-Z in lower case, its count in training texts and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(0), PIECE):
                mine = batch.column(1).slice(at, len(texts)).to_numpy(zero_copy_only=False)
                at += len(texts)
                bounds, codes, distinct = coded_words(pc.ascii_lower(texts))
                n = np.bincount(codes, minlength=len(distinct))
                c = np.bincount(codes[np.repeat(mine, np.diff(bounds))], minlength=len(distinct))
                yield pa.RecordBatch.from_arrays(
                    [distinct.cast(pa.string()), pa.array(c, pa.int64()), pa.array(n, pa.int64())], ["word", "c", "n"])

    each = docs.select(F.col(text_col).alias("text"), trained.alias("mine")).mapInArrow(count, "word string, c long, n long")
    return each.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _piece_counts(words: DataFrame, lattice: Lattice) -> np.ndarray:
    """Expected uses of every piece over all training words; one row per piece reaches the driver."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            weight = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            mine = shared.value.expected_counts(*byte_rows(batch.column(0)), weight)
            total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())], ["piece", "uses"])

    rows = words.where("c > 0").select("word", "c").mapInArrow(count, "piece int, uses double").groupBy("piece").agg(
        F.sum("uses").alias("uses")).collect()
    out = np.zeros(len(lattice.logp))
    for r in rows:
        out[r["piece"]] = r["uses"]
    return out


def fit(docs: DataFrame, trained: Column, text_col: str = "text", vocabulary: str = VOCABULARY, head: int = HEAD) -> Model:
    """Learn from the rows of ``docs`` where ``trained`` holds; the words of all rows are scored."""
    spark = docs.sparkSession
    counts = materialise(word_counts(docs, text_col, trained), "word-counts")
    ends = docs.where(trained).count()
    n_words, v_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = n_words + ends, v_words + int(ends > 0)

    names, prior = read_vocabulary(vocabulary)
    lattice = Lattice.of(names, prior)
    uses = _piece_counts(counts, lattice) + PRIOR * np.exp(prior)
    uses[-1] = ends + PRIOR * math.exp(prior[-1])
    lattice = lattice.with_weights(np.log(uses / uses.sum()))
    rest = math.log(v / (n + v)) if n else 0.0
    shared = spark.sparkContext.broadcast(lattice)

    @F.arrow_udf("double")
    def cuts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(shared.value.log_probability(*byte_rows(batch)), pa.float64())

    base = F.log((F.col("c") + 1) / F.lit(float(n + v + 1)))
    # log(c / (N + V) + exp(through)), from the larger of the two.
    through = F.col("cut") + F.lit(rest)
    whole = F.log(F.col("c") / F.lit(float(max(1, n + v))))
    high, low = F.greatest(through, whole), F.least(through, whole)
    scored = counts.withColumn("cut", cuts("word")).select(
        "word", "c", "n", base.alias("base"),
        F.when(F.col("c") == 0, through).otherwise(high + F.log1p(F.exp(low - high))).alias("score"))
    words = materialise(scored, "words")

    # The frequent words: the least count that not more than `head` words reach. There are
    # at most about sqrt(2 * tokens) different counts.
    sizes = words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    least, held = None, 0
    for row in sizes.toLocalIterator():
        held += row["words"]
        if held > head:
            break
        least = row["n"]
    frequent = words.where(F.col("n") >= least) if least is not None else words.limit(0)
    table = frequent.select("word", "c", "base", "score").toPandas()
    through_end = lattice.logp[-1] + rest
    end_score = float(np.logaddexp(math.log(ends / (n + v)), through_end)) if ends else float(through_end)
    rare = words.where(F.col("n") < least) if least is not None else words
    return Model(rare, table, (math.log((ends + 1) / (n + v + 1)), end_score), ends > 0, n, v)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every row; logarithms to base 10.

    Null and empty texts have one token, the end. Repeated rows get equal results, null ids
    are kept, other columns are not read, and an empty table gives no rows. Every word must
    have been among the rows that the model was fitted with, trained on or not.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.head["word"].tolist(), *[model.head[k].to_numpy() for k in ("c", "base", "score")]))
    kind = "struct<n_words long, n_known long, base double, score double, rare array<string>>"

    @F.arrow_udf(kind)
    def common(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, c, base, own = shared.value
        lookup = pa.array(names, pa.large_string())
        # The last place stands for a word that is not frequent.
        known, base, own = np.append(c > 0, 0), np.append(base, 0.0), np.append(own, 0.0)
        for batch in batches:
            out = []
            for texts in pieces(batch, PIECE):
                bounds, codes, distinct = coded_words(pc.ascii_lower(texts))
                at = pc.fill_null(pc.index_in(distinct, lookup), len(names)).to_numpy(zero_copy_only=False)
                found = at[codes]
                run = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[found])])[bounds])  # noqa: B023, E731
                rare = found == len(names)
                sums = lambda x: _by_text(x[found], bounds)  # noqa: B023, E731
                ends = np.concatenate([[0], np.cumsum(rare)])[bounds]
                words = distinct.take(pa.array(codes[rare])).cast(pa.string())
                out.append(pa.StructArray.from_arrays([
                    pa.array(np.diff(bounds), pa.int64()), pa.array(run(known.astype(np.int64)), pa.int64()),
                    pa.array(sums(base), pa.float64()), pa.array(sums(own), pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words),
                ], ["n_words", "n_known", "base", "score", "rare"]))
            yield pa.concat_arrays(out) if out else pa.array([], pa.struct([
                ("n_words", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
                ("rare", pa.list_(pa.string()))]))

    first = docs.select(F.col(id_col).alias("id"), common(F.col(text_col)).alias("s")).select(
        F.monotonically_increasing_id().alias("row"), "id", "s.*")
    first = materialise(first, "frequent-words")
    rare = first.select("row", F.explode("rare").alias("word")).join(model.words, "word").groupBy("row").agg(
        F.sum((F.col("c") > 0).cast("long")).alias("more_known"), F.sum("base").alias("more_base"),
        F.sum("score").alias("more_score"))
    total = first.drop("rare").join(rare, "row", "left")
    both = lambda a, b, end: F.col(a) + F.coalesce(F.col(b), F.lit(0)) + F.lit(end)
    return total.select(
        F.col("id").alias(id_col), (F.col("n_words") + 1).alias("n_tokens"),
        both("n_known", "more_known", int(model.end_known)).alias("n_known"),
        (both("base", "more_base", model.end[0]) / LOG10).alias("base_score"),
        (both("score", "more_score", model.end[1]) / LOG10).alias("score"))


def _by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums per text, each added up by itself so that long batches lose no digits."""
    if not len(values):
        return np.zeros(len(bounds) - 1)
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros(len(bounds) - 1)
    out[full] = np.add.reduceat(values, bounds[:-1][full])
    return out

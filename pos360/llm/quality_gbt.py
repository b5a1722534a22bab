"""Operator 3, quality classifier: histogram gradient-boosted trees.

Document statistics (ratios of the counts in text_counts.py, no ids, labels or
sources) are cut
into at most 255 quantile bins. Trees grow level by level on histograms of
gradients and hessians, and are flattened into arrays that numpy walks for
thousands of documents at once.

The model is fitted on at most `sample` labelled documents, those with the
smallest hashes of their ids; their statistics, a few numbers each, are all that
reaches the driver. Every document is scored from its whole text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.llm.tables import packed, pieces, read_table
from pos360.llm.text_counts import counts

SAMPLE = 20_000
KEEP_FROM = 0.3
FOLDS = 5
BINS = 255
TREES, DEPTH, RATE, L2, LEAST_HESSIAN = 80, 4, 0.15, 1.0, 1.0

FEATURES = ("log_words", "log_bytes", "word_length", "symbols", "distinct", "repeats", "dup_lines", "capitals", "digits", "punctuation", "bytes_per_char", "words_per_line", "exclamations", "pipes", "stops")


def features(column) -> np.ndarray:
    """One row of statistics per text; empty texts give zeros."""
    c = {k: v.astype(float) for k, v in counts(column).items()}

    def per(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)

    w, ch = c["n_words"], c["word_chars"]
    return np.column_stack([
        np.log1p(w), np.log1p(c["n_bytes"]), per(ch, w), per(c["n_symbols"], ch), per(c["n_distinct_words"], w), per(c["n_repeat_words"], w), per(c["n_dup_lines"], c["n_lines"]),
        per(c["n_capitals"], ch), per(c["n_digits"], ch), per(c["n_punctuation"], w), per(c["n_bytes"], c["n_chars"]), per(w, c["n_lines"]), per(c["n_exclamations"], w), per(c["n_pipes"], w), per(c["n_stops"], w),
    ])


@dataclass
class Forest:
    """Trees as flat arrays: node i goes to left[i], or left[i] + 1 if the value exceeds cut[i]; leaves point at themselves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = self.left[node] + (x[row, self.feature[node]] > self.cut[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Ascending bin borders of each feature, between distinct values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) > BINS - 1:
            middle = np.unique(middle[np.linspace(0, len(middle) - 1, BINS - 1).astype(int)])
        out.append(middle)
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosted trees for the log loss. Without rows of both labels all scores are the labels' smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    feature, cut, left, value, roots = [], [], [], [], []

    def leaf(v: float) -> int:
        feature.append(0), cut.append(np.inf), left.append(len(left)), value.append(v)
        return len(left) - 1

    if len(y) == 0 or y.min() == y.max():
        roots.append(leaf(0.0))
        return Forest(np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(roots), base, depth)
    borders = _cuts(x)
    binned = np.column_stack([np.searchsorted(b, column, "left") for b, column in zip(borders, x.T)])
    margin = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        roots.append(leaf(0.0))
        node = np.full(len(y), roots[-1])
        level = [roots[-1]]
        for _ in range(depth):
            place = {n: i for i, n in enumerate(level)}
            rows = np.flatnonzero(np.isin(node, level))
            if not len(rows):
                break
            where = np.array([place[n] for n in node[rows]])
            total_g = np.bincount(where, gradient[rows], len(level))
            total_h = np.bincount(where, hessian[rows], len(level))
            best = [(1e-6, -1, 0)] * len(level)
            for j in range(x.shape[1]):
                if not len(borders[j]):
                    continue
                slot = where * (BINS + 1) + binned[rows, j]
                g = np.bincount(slot, gradient[rows], len(level) * (BINS + 1)).reshape(len(level), -1).cumsum(axis=1)
                h = np.bincount(slot, hessian[rows], len(level) * (BINS + 1)).reshape(len(level), -1).cumsum(axis=1)
                rest_g, rest_h = total_g[:, None] - g, total_h[:, None] - h
                gain = g**2 / (h + L2) + rest_g**2 / (rest_h + L2) - (total_g**2 / (total_h + L2))[:, None]
                gain[(h < LEAST_HESSIAN) | (rest_h < LEAST_HESSIAN)] = -1
                gain = gain[:, : len(borders[j])]
                top = gain.argmax(axis=1)
                for i, b in enumerate(top.tolist()):
                    if gain[i, b] > best[i][0]:
                        best[i] = (float(gain[i, b]), j, b)
            grown = []
            for n, (_, j, b) in zip(level, best):
                if j < 0:
                    continue
                mine = node == n
                feature[n], cut[n] = j, float(borders[j][b])
                left[n] = leaf(0.0)
                leaf(0.0)
                node[mine] = left[n] + (binned[mine, j] > b)
                grown += [left[n], left[n] + 1]
            level = grown
        for n in np.unique(node).tolist():
            mine = node == n
            value[n] = RATE * float(gradient[mine].sum() / (hessian[mine].sum() + L2))
        margin += np.array(value)[node]
    return Forest(np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(roots), base, depth)


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on labelled documents outside the held-out fold, at most `sample` of them."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (_fold(F.col("doc_id")) != 0))
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    # A cut of the ids' hashes that is expected to keep a little less than `sample`; the limit makes the bound hard.
    share = min(1.0, 0.97 * sample / max(1, one.count()))
    picked = (one if share == 1 else one.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(1 << 40)) < int(share * (1 << 40)))).limit(sample)
    # The sample is bounded by its parameter: `sample` ids and labels are what is broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["quality"].cast(pa.int32()), *[pa.array(f) for f in features(b["text"]).T]], ["doc_id", "quality", *FEATURES])

    got = rows.mapInArrow(run, "doc_id long, quality int, " + ", ".join(f"{f} double" for f in FEATURES))
    # Ids may repeat in the documents: one row of each id is kept, so the bound holds for rows as well.
    table = got.groupBy("doc_id").agg(F.min(F.struct("quality", *FEATURES)).alias("row")).select("doc_id", "row.*").toArrow().sort_by("doc_id")
    x = np.column_stack([np.asarray(table[f]) for f in FEATURES]) if table.num_rows else np.zeros((0, len(FEATURES)))
    return fit(x, np.asarray(table["quality"]).astype(float))


def score(docs: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """docs with a score column."""
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.scores(features(b["text"])))], [*b.schema.names, name])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Defined cases: null texts are empty, and empty texts are scored like any
    other; a null id counts as the empty string in the fold rule and has no
    label; a document with several labels takes the largest; repeated ids and
    equal rows get a row each; without labels of both kinds every score is their
    smoothed share; an empty table gives no row; other columns do not matter."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scored = score(rows, train(docs, labels, sample))
    return scored.select("doc_id", (_fold(F.col("doc_id")) == 0).alias("held_out"), "score", F.when(F.col("score") >= KEEP_FROM, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are predicted good, with their own columns."""
    return score(packed(docs), train(docs, labels, sample)).where(F.col("score") >= KEEP_FROM).select("row.*")


def op3_boosted_tree_quality(spark, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))

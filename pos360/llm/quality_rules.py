"""Operator 7, quality rules with risk-controlled thresholds.

Base counts come from every whole text. On top of two fixed base rules, ratios
of counts get cutoffs per stratum (language), chosen on labelled documents in
two halves. The choosing half gives a path of joint cutoffs: starting with none,
each step makes one rule stricter, by the steps of all rules in descending share
of bad among the documents that they remove, as far as this is over a half. The
holdout half tests the path: step by step an exact binomial test must reject
"the rules up to here remove more than the allowed share of good documents" at
the corrected level, and the first step that it doesn't ends the path
(fixed-sequence testing within a stratum, Bonferroni over the strata). So the
risk is spent once, on all rules together, and no cutoff of a stratum counts
more than its own holdout documents do."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pos360.llm.tables import pieces, read_table, written
from pos360.llm.text_counts import counts

RISK = 0.05  # share of a stratum's good documents that its cutoffs may remove in all
ERROR = 0.05  # chance that any stratum breaks its share
MIN_WORDS, MAX_REPEAT = 20, 30  # base rules: words at least, percent of repeated words at most
LAST_BIN = 1000  # of a share in thousandths: no share is larger
LONGEST_WORD = 1 << 20  # code points: the mean word length has a bin of a twentieth of one up to here
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTED = (*BASE, "n_lines", "n_distinct_words", "n_capitals", "n_punctuation", "n_digits")

#: Rule, numerator, denominator, and how many bins a ratio of one has. A text fails where its bin is above the cutoff.
RULES = (
    ("symbols", "n_symbols", "word_chars", LAST_BIN),
    ("dup_lines", "n_dup_lines", "n_lines", LAST_BIN),
    ("repeat_words", "n_repeat_words", "n_words", LAST_BIN),
    ("word_length", "word_chars", "n_words", 20),
    ("same_words", "n_words - n_distinct_words", "n_words", LAST_BIN),
    ("capitals", "n_capitals", "word_chars", LAST_BIN),
    ("punctuation", "n_punctuation", "word_chars", LAST_BIN),
    ("digits", "n_digits", "word_chars", LAST_BIN),
)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed exactly from the logs of its terms."""
    if k >= n:
        return 1.0
    base, log_p, log_q = math.lgamma(n + 1), math.log(p), math.log1p(-p)
    terms = [base - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q for i in range(k + 1)]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def rule_steps(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> list[tuple[float, int]]:
    """(share of bad, cutoff) of a rule's steps, from the mildest to the strictest that pays.

    bins ascend; good and bad are the choosing half's documents in each. A step
    ends where the share of bad among the documents it removes is largest (the
    upper convex hull of bad over removed), so shares descend and are over a half."""
    steps, upto = [], len(bins)
    while upto > 1:
        removed = np.cumsum((good + bad)[1:upto][::-1])
        share = np.cumsum(bad[1:upto][::-1]) / np.maximum(removed, 1)
        best = len(share) - 1 - int(np.argmax(share[::-1]))  # the longest of the best
        if share[best] <= 0.5:
            break
        upto -= best + 1
        steps.append((float(share[best]), int(bins[upto]) - 1))
    return steps


def joint_path(rule: np.ndarray, bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> list[tuple[int, int]]:
    """(rule, cutoff) of the steps of all rules of a stratum, in the order in which they are to be tested."""
    steps = []
    for r in np.unique(rule):
        mine = np.flatnonzero(rule == r)
        mine = mine[np.argsort(bins[mine])]
        steps += [(-share, int(r), -i, cutoff) for i, (share, cutoff) in enumerate(rule_steps(bins[mine], good[mine], bad[mine]))]
    return [(r, cutoff) for _, r, _, cutoff in sorted(steps, key=lambda x: (x[0], x[1], -x[2]))]


def certified(good_removed: np.ndarray, n_good: int, risk: float, level: float) -> int:
    """How many steps of a path hold the risk: good_removed[i] holdout documents of n_good go by step i or earlier."""
    for i, k in enumerate(good_removed.tolist()):
        # Beyond the allowed share no test can certify; this also bounds the tail's terms.
        if k > risk * n_good or binomial_tail(k, n_good, risk) > level:
            return i
    return len(good_removed)


def _bin(numerator: str, denominator: str, scale: int) -> Column:
    numerator, denominator = F.expr(numerator), F.expr(denominator)
    return F.when(denominator > 0, F.least(F.floor(numerator * scale / denominator), F.lit(LAST_BIN if scale == LAST_BIN else scale * LONGEST_WORD))).otherwise(0).cast("int")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and the counts of each text."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")).alias("stratum"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches):
            c = counts(b["text"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["stratum"], *[pa.array(c[k], pa.int64()) for k in COUNTED]], ["doc_id", "stratum", *COUNTED])

    return rows.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTED))


def cutoffs(binned: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum, steps (array of (rule, cutoff), the certified part of its path), from all labelled documents.

    A document with several labels counts as good if any of them says so; a hash
    of its id says to which half it belongs. Only counts by bin and by step are
    brought together for a stratum, both bounded by rules and bins."""
    good = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("quality") == 1).alias("good"))
    known = binned.where(~F.col("base_failed")).join(good, "doc_id").withColumn("holdout", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 0)
    per_bin = known.where(~F.col("holdout")).select("stratum", "good", F.posexplode("bins").alias("rule", "bin")).groupBy("stratum", "rule", "bin").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    level = error / max(1, binned.select("stratum").distinct().count())

    def choose(t: pa.Table) -> pa.Table:
        path = joint_path(*[np.asarray(t[c]) for c in ("rule", "bin", "good", "bad")])
        steps = pa.array([[{"rule": r, "cutoff": c} for r, c in path]], pa.list_(pa.struct([("rule", pa.int32()), ("cutoff", pa.int32())])))
        return pa.table({"stratum": t["stratum"][:1], "steps": steps})

    paths = written(per_bin.groupBy("stratum").applyInArrow(choose, "stratum string, steps array<struct<rule:int,cutoff:int>>"), "quality-paths")
    # The first step that removes a holdout document, 0 for none.
    first = F.array_position(F.transform("steps", lambda s: F.get("bins", s["rule"]) > s["cutoff"]), True)
    removed = known.where(F.col("holdout") & F.col("good")).join(paths, "stratum").groupBy("stratum", first.alias("step")).agg(F.count(F.lit(1)).alias("n"))

    def test(t: pa.Table) -> pa.Table:
        step, n = np.asarray(t["step"]).astype(np.int64), np.asarray(t["n"])
        by_step = np.bincount(step, n, int(step.max()) + 1).astype(np.int64)
        return pa.table({"stratum": t["stratum"][:1], "last": pa.array([certified(np.cumsum(by_step[1:]), int(n.sum()), risk, level)], pa.int32()), "tested": pa.array([len(by_step) - 1], pa.int32()), "n_good": pa.array([int(n.sum())], pa.int64())})

    held = removed.groupBy("stratum").applyInArrow(test, "stratum string, last int, tested int, n_good long")
    # Steps behind the last that removes a holdout document at all remove as many: they stand or fall with it.
    upto = F.when(F.col("last") < F.col("tested"), F.col("last")).otherwise(F.size("steps"))
    fewest = math.log(level) / math.log1p(-risk)  # good documents from which on removing none of them is certified
    return paths.join(held, "stratum").where(F.col("n_good") >= F.lit(fewest)).select("stratum", F.slice("steps", 1, upto).alias("steps"))


def judge_quality(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, and failed (the rules it broke).

    Defined cases: null text has no words and fails the base rules; a null
    language is a stratum of its own; null or repeated ids get their row each,
    a null id has no label; with no labels (or too few to certify a cutoff) only
    the base rules remove; an empty table gives no row; other columns do not
    matter. The counts are written once and read for both the cutoffs and the
    verdicts; the texts are read once."""
    failed_base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    counted = written(base_counts(docs), "quality-rules")
    binned = counted.withColumn("base_failed", failed_base).withColumn("bins", F.array(*[_bin(n, d, s) for _, n, d, s in RULES]))
    per_stratum = cutoffs(binned, labels, risk, error)
    names = F.array(*[F.lit(r[0]) for r in RULES])
    over = F.array_sort(F.array_distinct(F.transform(F.filter("steps", lambda s: F.get("bins", s["rule"]) > s["cutoff"]), lambda s: s["rule"])))
    return (
        binned.join(per_stratum, "stratum", "left")
        .withColumn("broken", F.when(F.col("steps").isNull(), F.array().cast("array<int>")).otherwise(over))
        .select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), F.transform("broken", lambda i: F.get(names, i)).alias("failed"))
    )


def op7_risk_controlled_rules(spark, sf_dir: str) -> DataFrame:
    return judge_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))

"""Operators 7 and 3."""

import math
import zlib
from fractions import Fraction

import numpy as np

import brute
from corpus import DOCS, rows, texts
from pos360.llm import quality_gbt, quality_rules
from pos360.llm.tables import read_table

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_base_counts(spark):
    t = texts(4)
    out = quality_rules.judge_quality(spark.createDataFrame(rows(t), DOCS), spark.createDataFrame([], LABELS)).collect()
    for r in out:
        want = brute.base_counts(t[r.doc_id])
        assert tuple(r[c] for c in quality_rules.BASE) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and r.kept == (not r.base_failed)
    assert len(out) == len(t)


def test_binomial_tail_is_exact():
    for k, n, p in ((0, 10, 0.1), (3, 10, 0.5), (7, 60, 0.05), (5, 5, 0.3)):
        q = Fraction(str(p))
        exact = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality_rules.binomial_tail(k, n, p), float(exact), rel_tol=1e-12)


def test_steps_of_a_rule_descend_in_share():
    bins, good, bad = np.array([0, 10, 20, 30, 40]), np.array([900, 100, 3, 0, 1]), np.array([0, 30, 40, 40, 9])
    # From the top: 49 bad of 50 in the bins 30 and 40, then 40 of 43 in bin 20; bin 10 is mostly good.
    assert quality_rules.rule_steps(bins, good, bad) == [(49 / 50, 29), (40 / 43, 19)]
    assert quality_rules.rule_steps(bins, good, 0 * bad) == [] and quality_rules.rule_steps(bins[:1], bad[:1], good[:1]) == []
    # Steps of several rules come by their share of bad.
    path = quality_rules.joint_path(np.repeat([0, 3], [5, 2]), np.r_[bins, [0, 40]], np.r_[good, [900, 0]], np.r_[bad, [0, 7]])
    assert path == [(3, 39), (0, 29), (0, 19)]


def test_a_path_ends_where_the_risk_is_not_certified():
    assert quality_rules.certified(np.array([0, 0, 2, 60]), 1000, 0.05, 0.01) == 3
    assert quality_rules.certified(np.array([0, 0]), 50, 0.05, 0.0125) == 0  # too few good documents certify nothing
    assert quality_rules.certified(np.array([0]), 86, 0.05, 0.0125) == 1
    assert quality_rules.certified(np.array([5, 5]), 20, 0.05, 0.5) == 0


def verdicts_by_force(counted, labels, risk=quality_rules.RISK, error=quality_rules.ERROR):
    """{row: kept} from the counts, path and tests spelled out document by document."""
    def bins(r):
        out = []
        for _, num, den, scale in quality_rules.RULES:
            top = r["n_words"] - r["n_distinct_words"] if "-" in num else r[num]
            out.append(min(top * scale // r[den], 1000 if scale == 1000 else 1 << 40) if r[den] else 0)
        return out

    rows_ = [(i, r["stratum"], r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"], bins(r), labels.get(i), r["half"]) for i, r in counted.items()]
    strata = {s for _, s, *_ in rows_}
    kept = {}
    for s in strata:
        mine = [x for x in rows_ if x[1] == s and not x[2] and x[4] is not None]
        chosen, held = [x for x in mine if x[5] == 1], [x for x in mine if x[5] == 0 and x[4]]
        cells = sorted({(k, b) for x in chosen for k, b in enumerate(x[3])})
        path = quality_rules.joint_path(*[np.array(c) for c in zip(*[
            (k, b, sum(x[3][k] == b and x[4] for x in chosen), sum(x[3][k] == b and not x[4] for x in chosen)) for k, b in cells])]) if cells else []
        done = []
        for step in range(1, len(path) + 1):
            gone = sum(any(x[3][k] > c for k, c in path[:step]) for x in held)
            if gone > risk * len(held) or quality_rules.binomial_tail(gone, len(held), risk) > error / len(strata):
                break
            done = path[:step]
        for i, t, failed, b, *_ in rows_:
            if t == s:
                kept[i] = not failed and not any(b[k] > c for k, c in done)
    return kept


def test_verdicts_match_brute_force_and_differ_from_the_base_rules(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    half = quality_rules.F.pmod(quality_rules.F.xxhash64("doc_id", quality_rules.F.lit(7)), quality_rules.F.lit(2)).cast("int").alias("half")
    counted = {r["doc_id"]: r.asDict() for r in quality_rules.base_counts(docs).select("*", half).collect()}
    known = {r.doc_id: r.quality == 1 for r in labels.collect() if r.quality is not None}
    out = quality_rules.judge_quality(docs, labels).collect()
    assert {r.doc_id: r.kept for r in out} == verdicts_by_force(counted, known)
    removed = [r for r in out if not r.base_failed and not r.kept]
    assert removed and sum(known.get(r.doc_id, False) for r in removed) <= 0.05 * sum(known.values())


def test_risk_holds_in_most_draws():
    """Of many draws of labels, a tested path breaks the risk in no more than the error's share."""
    rng, broken = np.random.default_rng(5), 0
    truth = np.array([0.0, 0.02, 0.045, 0.06, 0.09])  # share of good documents that the steps remove
    for _ in range(2000):
        at = np.searchsorted(truth, rng.random(300), "left")  # a document goes by the first step that reaches it
        removed = np.array([(at <= i).sum() if i else 0 for i in range(len(truth))])
        last = quality_rules.certified(removed, 300, 0.05, 0.05)
        broken += last > 0 and truth[last - 1] > 0.05
    assert broken <= 0.06 * 2000


def test_cutoffs_hold_their_risk(spark):
    """With enough labels junk goes and good documents stay, per stratum."""
    good = [" ".join(f"w{(i * 7 + j) % 97}" for j in range(30)) for i in range(3000)]
    junk = [" ".join(f"w{(i * 5 + j) % 89}###" for j in range(30)) for i in range(150)]
    t = good + junk
    docs = spark.createDataFrame([(i, x, "en") for i, x in enumerate(t)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < len(good)), 0) for i in range(len(t))], LABELS)
    out = quality_rules.judge_quality(docs, labels).collect()
    assert sum(r.kept for r in out if r.doc_id < len(good)) == len(good)
    assert not any(r.kept for r in out if r.doc_id >= len(good)) and any("symbols" in r.failed for r in out)


def test_rules_on_empty_and_null(spark):
    empty = spark.createDataFrame([], DOCS)
    assert quality_rules.judge_quality(empty, spark.createDataFrame([], LABELS)).count() == 0
    docs = spark.createDataFrame(rows([None, "a b"], [None, 1]), DOCS)
    assert [r.kept for r in quality_rules.judge_quality(docs, spark.createDataFrame([(None, 1, 0), (1, None, 0)], LABELS)).collect()] == [False, False]


def test_forest_learns_and_walks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = quality_gbt.fit(x[:2000], y[:2000], trees=40)
    scores = forest.scores(x[2000:])
    assert ((scores >= 0.5) == y[2000:]).mean() > 0.95 and 0 <= scores.min() and scores.max() <= 1
    assert np.allclose(quality_gbt.fit(x[:5], np.ones(5)).scores(x[:3]), 6 / 7)
    assert np.allclose(quality_gbt.fit(x[:0], y[:0]).scores(x[:2]), 0.5)


def test_held_out_accuracy(spark):
    out = quality_gbt.classify(read_table(spark, SF, "documents"), read_table(spark, SF, "labels")).toPandas()
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(out.doc_id, out.held_out))
    assert ((out.score >= 0.3) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    known = out.merge(read_table(spark, SF, "labels").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert (held[held.quality == 1].predicted == 1).mean() > 0.98


def test_classifier_ignores_ids_and_sources(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    forest = quality_gbt.train(docs, labels)
    a = quality_gbt.score(docs, forest).select("doc_id", "score").toPandas()
    other = docs.selectExpr("doc_id + 7 as doc_id", "text", "'xx' as lang", "null as source", "n_chars")
    b = quality_gbt.score(other, forest).selectExpr("doc_id - 7 as doc_id", "score").toPandas()
    assert a.merge(b, on="doc_id").eval("score_x == score_y").all()


def test_classifier_on_empty_and_null(spark):
    none = spark.createDataFrame([], LABELS)
    assert quality_gbt.classify(spark.createDataFrame([], DOCS), none).count() == 0
    out = quality_gbt.classify(spark.createDataFrame(rows([None, ""], [None, 1]), DOCS), none).collect()
    assert [(r.score, r.predicted) for r in out] == [(0.5, 1), (0.5, 1)]

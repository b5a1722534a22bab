"""Operator 11 against brute force: every rule tried everywhere, suppression by comparing all pairs."""

import itertools
import re

from pyspark.sql import functions as F

import brute
from corpus import DOCS, rows, texts
from pos360.llm.license_rules import MAX_WORDS, Rule, rules
from pos360.llm.license_scan import detections


def scan(text, known):
    """(n_words, base places, detections that are left), by all pairs."""
    w = brute.ALNUM.findall(brute.lower(text or ""))
    found = []
    for r in known:
        for i in range(len(w)):
            m = re.match(f"(?:{r.pattern})(?= |$)", " ".join(w[i : i + MAX_WORDS]))
            if m and i + r.lead < len(w) and w[i + r.lead] == r.keyword:
                found.append((i, i + len(m[0].split()), r))

    def better(a, b):
        return (a[2].priority, a[0] - a[1], a[2].order) < (b[2].priority, b[0] - b[1], b[2].order)

    outer = [d for d in found if not any(
        e is not d and e[0] <= d[0] and e[1] >= d[1] and ((e[0], e[1]) != (d[0], d[1]) or better(e, d)) for e in found)]
    kept = [d for d in outer if not any(e[0] < d[1] and d[0] < e[1] and better(e, d) for e in outer)]
    base = sorted((a, b, r.label) for a, b, r in found if r.base)
    return len(w), base, sorted((a, b, r.label) for a, b, r in kept)


def answer(docs, known=None):
    out = detections(docs, known).collect()
    return sorted(((r.doc_id, r.n_words, [d[:3] for d in r.base], [d[:3] for d in r.licenses]) for r in out), key=repr)


def example(pattern):
    """Some text that the pattern matches."""
    while (new := re.sub(r"\(\?:([^()|]*)[^()]*\)(\??)", lambda m: "" if m[2] else m[1], pattern)) != pattern:
        pattern = new
    pattern = re.sub(r"\[\^ \]\+", "x", pattern)
    pattern = re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)
    return re.sub(r" +", " ", re.sub(r"([a-z])\?", "", re.sub(r" \?", " ", pattern))).strip()


def test_every_rule_can_be_found():
    known = rules()
    assert len(known) > 300 and [r.order for r in known] == list(range(len(known)))
    for r in known:
        words = example(r.pattern).split()
        assert re.fullmatch(r.pattern, " ".join(words)), r
        assert words[r.lead] == r.keyword and len(words) <= MAX_WORDS, r


def test_matches_brute_force(spark):
    known = rules()
    notices = [example(r.pattern) for r in known]
    t = texts(3, 25) + [
        "Licensed under CC BY-NC 4.0. All rights reserved!", "cc by cc by CC-BY cc  by", "the GNU General Public License, version 3 or later",
        "GNU Affero General Public License\nversion 3; general public license general PUBLIC license", "rights reserved all rights reserved",
        "all rights reserved " * 300, "ccby cc bye all rights", "Released under the MIT License", "cc", "by", "reserved",
    ]
    t += [f"{a} {b}" for a, b in zip(notices, notices[7:] + notices[:7])] + [" ".join(notices)]
    docs = spark.createDataFrame(rows(t), DOCS)
    assert answer(docs) == sorted(((i, *scan(x, known)) for i, x in enumerate(t)), key=repr)


def test_overlaps_of_all_kinds(spark):
    """Rules over three words that lie across, inside and on each other, in every order of priority."""
    patterns = [("a b", "a", 0), ("b a", "a", 1), ("a b a", "b", 1), ("b", "b", 0), ("a a", "a", 0), ("a b b a", "b", 2), ("a b", "b", 1)]
    for shift in range(len(patterns)):
        known = [Rule(i, f"r{i}", 1 + (i * 3 + shift) % 4, 0.5, k, lead, p) for i, (p, k, lead) in enumerate(patterns)]
        t = [" ".join(x) for n in (1, 3, 5) for x in itertools.product("abc", repeat=n)]
        docs = spark.createDataFrame(rows(t), DOCS)
        assert answer(docs, known) == sorted(((i, *scan(x, known)) for i, x in enumerate(t)), key=repr)


def test_edge_tables_and_no_python(spark):
    docs = spark.createDataFrame(rows(["CC BY", None, "cc by", "cc by"], [1, None, 1, 1]), DOCS)
    assert answer(docs) == sorted([(None, 0, [], [])] + [(1, 2, [(0, 2, "cc-by")], [(0, 2, "cc-by")])] * 3, key=repr)
    assert answer(docs.where(F.lit(False))) == []
    clash = docs.withColumn("scan", F.lit(1)).withColumn("base", F.lit(2)).withColumn("n_words", F.lit(3))
    assert answer(clash) == answer(docs)
    plan = detections(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan

"""Operator 11, license scans: ordered signature rules over words.

Every rule of `license_rules` has a keyword, and a text is asked only for the
rules whose keywords it holds: one hash lookup of its words against all
keywords, then the places of those found. At such a place the rule's regular
expression is tried on the few words around it, so a text's cost follows its
keywords and not the number of rules. Detections that overlap are resolved:

1. one that lies inside another goes (of equal intervals the better rule stays);
2. of those left, one goes that overlaps a better one: smaller priority number,
   then longer, then the earlier rule.

Both steps look at no more than MAX_WORDS neighbours of a detection: after the
first part of step 1 no two start at the same word, and no match is longer.

The whole scan is one expression per row: nothing is shuffled, no row waits for
another, and a source that holds a third of all rows is worked off by as many
tasks as it has splits."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pos360.llm.license_rules import MAX_WORDS, Rule, rules
from pos360.llm.tables import read_table

# ASCII characters between words: all but letters and digits.
_BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())
_RULES = "map<string,array<struct<order:int,label:string,priority:int,weight:double,lead:int,pattern:string,base:boolean>>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lowered; none of a null text."""
    spaced = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase + _BETWEEN, ascii_lowercase + " " * len(_BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def _table(known: Sequence[Rule]) -> Column:
    """Map of keyword to its rules, a constant."""
    table: dict[str, list[dict]] = {}
    for r in known:
        fields = {k: v for k, v in r._asdict().items() if k != "keyword"}
        table.setdefault(r.keyword, []).append(fields | {"pattern": f"^(?:{r.pattern})(?= |$)"})
    return F.from_json(F.lit(json.dumps(table)), _RULES)


def _found(words: Column, known: Sequence[Rule]) -> Column:
    """All matches of all rules as (start, minus_end, priority, order, ...), sorted."""
    table = _table(known)

    def one(r: Column, at: Column) -> Column:
        start = at - r["lead"]
        near = F.array_join(F.slice(words, start + 1, MAX_WORDS), " ")
        match = F.call_function("regexp_extract", near, r["pattern"], F.lit(0))
        n = F.when(match == "", 0).otherwise(F.length(match) - F.length(F.replace(match, F.lit(" "), F.lit(""))) + 1)
        return F.struct(
            start.alias("start"), (-start - n).alias("minus_end"), r["priority"].alias("priority"), r["order"].alias("order"),
            (start + n).alias("end"), r["label"].alias("label"), r["weight"].alias("weight"), r["base"].alias("base"),
        )

    def at_place(at: Column) -> Column:
        tried = F.filter(F.element_at(table, F.get(words, at)), lambda r: r["lead"] <= at)
        return F.filter(F.transform(tried, lambda r: one(r, at)), lambda d: d["end"] > d["start"])

    def places(present: Column) -> Column:
        every = F.when(F.size(present) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(every, lambda at: F.array_contains(present, F.get(words, at)))

    keywords = F.array(*map(F.lit, sorted({r.keyword for r in known})))
    return let(F.array_intersect(words, keywords), lambda present: F.array_sort(F.flatten(F.transform(places(present), at_place))))


def _resolved(found: Column) -> Column:
    """The detections that no other one suppresses, by start."""

    def rank(d: Column) -> Column:
        return F.struct(d["priority"], d["start"] - d["end"], d["order"])

    def before(all_: Column, i: Column) -> Column:
        return F.slice(all_, F.greatest(i - MAX_WORDS, F.lit(0)) + 1, F.least(i, F.lit(MAX_WORDS)))

    def around(all_: Column, i: Column) -> Column:
        return F.slice(all_, F.greatest(i - MAX_WORDS, F.lit(0)) + 1, 2 * MAX_WORDS + 1)

    longest = F.filter(found, lambda d, i: (i == 0) | (F.get(found, i - 1)["start"] != d["start"]))
    outer = let(longest, lambda x: F.filter(x, lambda d, i: ~F.exists(before(x, i), lambda e: e["end"] >= d["end"])))
    return let(
        outer,
        lambda x: F.filter(x, lambda d, i: ~F.exists(around(x, i), lambda e: (e["start"] < d["end"]) & (d["start"] < e["end"]) & (rank(e) < rank(d)))),
    )


def detections(docs: DataFrame, known: Sequence[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, base and licenses: one row per input row.

    base and licenses are arrays of (start, end, label, priority, weight, rule)
    by start, in words from 0, end exclusive: all places of the base phrases,
    whatever else is there, and the detections that are left of all rules.

    Defined cases: null and wordless texts have no words and no detections; null
    or repeated ids and equal rows get a row each; texts of any length are
    scanned whole; an empty table gives none; other columns, whatever their
    names, do not matter. Equal intervals of equal priority: the earlier rule."""
    known = rules() if known is None else known

    def shown(d: Column) -> Column:
        return F.struct(d["start"], d["end"], d["label"], d["priority"], d["weight"], d["order"].alias("rule"))

    def answer(words: Column) -> Column:
        return let(_found(words, known), lambda found: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.transform(F.filter(found, lambda d: d["base"]), shown).alias("base"),
            F.transform(_resolved(found), shown).alias("licenses"),
        ))

    scan = let(words_of(F.col("text").cast("string")), answer).alias("scan")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan).select("doc_id", "scan.n_words", "scan.base", "scan.licenses")


def op11_license_signatures(spark, sf_dir: str) -> DataFrame:
    found = detections(read_table(spark, sf_dir, "documents"))

    def labels(*columns: str) -> Column:
        every = F.concat(*(F.transform(c, lambda d: d["label"]) for c in columns))
        return F.array_join(F.array_sort(F.array_distinct(every)), ",")

    starts = F.transform("base", lambda d: d["start"].cast("long"))
    weights = F.transform(F.concat("base", "licenses"), lambda d: d["weight"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"), labels("base", "licenses").alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
    )

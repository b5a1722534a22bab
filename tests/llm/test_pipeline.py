"""The pipeline's stages, each against a brute-force version of its contract on its own input."""

import pytest

import brute
import corpus_pipeline as cp
from pos360.llm.quality_gbt import score, train
from pos360.llm.tables import read_table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = [], read_table(spark, SF, "documents")
    for name, stage in cp.STAGES:
        after = cp.written(stage(spark, docs, SF), name)
        out.append((name, docs.toPandas(), after.toPandas()))
        docs = after
    return {name: (a, b) for name, a, b in out}


def test_names_and_columns(stages):
    assert list(stages) == ["quality", "near_dedup", "substring_dedup", "decontamination", "encoding"]
    assert all(list(after.columns) == COLUMNS for name, (_, after) in stages.items() if name != "encoding")


def test_quality(spark, stages):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    good = {r.doc_id for r in score(docs, train(docs, labels)).collect() if r.score >= 0.3}
    assert set(stages["quality"][1].doc_id) == good


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    before = before.sort_values("doc_id")
    group = brute.groups([brute.fingerprint(t) for t in before.text])
    assert sorted(after.doc_id) == sorted({int(before.doc_id.iloc[g]) for g in group})


def test_substring_dedup(stages):
    before, after = stages["substring_dedup"]
    want = {r[0]: (r[1], r[2]) for r in brute.dedup_bytes(list(zip(before.doc_id, before.text)))}
    assert set(after.doc_id) == set(want)
    for r in after.itertuples():
        size, removed = want[r.doc_id]
        assert r.n_chars == len(r.text) and 0 <= size - removed - len(r.text.encode()) <= 2 * removed
    untouched = {i for i, (_, n) in want.items() if n == 0}
    assert after[after.doc_id.isin(untouched)].sort_values("doc_id").text.tolist() == before[before.doc_id.isin(untouched)].sort_values("doc_id").text.tolist()


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r)[:2] for r in read_table(spark, SF, "benchmark").select("item_id", "text").collect()]
    clean = {r[0] for r in brute.contamination(list(zip(before.doc_id, before.text)), items) if not r[-1]}
    assert set(after.doc_id) == clean


def test_encoding(stages):
    before, after = stages["encoding"]
    assert sorted(after.doc_id) == sorted(before.doc_id) and after.round_trip.all() and (after.n_tokens == after.ids.map(len)).all()


def test_empty_documents(spark):
    docs = read_table(spark, SF, "documents").where("false")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, `row` string, `number` long, `#row` long, `#hit` string, `#n_words` int, `score` double, `fingerprint` long, `bytes` string"


def test_nulls_repeats_and_clashing_names(spark):
    """Null ids and texts, equal rows, an odd long text and columns named like the stages' own: rows come out with their own columns."""
    long = "語" * 3000 + " ".join(f"w{i}" for i in range(5000))
    texts = [None, None, "", "the quick brown fox jumps over the lazy dog", "the quick brown fox jumps over the lazy dog", long]
    rows = [(i if n % 2 else None, t, None, None, None, "r", 7, 8, "h", 9, 0.5, 1, "b") for n, (i, t) in enumerate(zip([1, 1, 2, 3, 3, 4], texts))]
    docs = spark.createDataFrame(rows, AWKWARD)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        got = out.collect()
        assert all((r["row"], r["number"], r["#row"], r["#hit"], r["#n_words"], r["score"], r["fingerprint"], r["bytes"]) == ("r", 7, 8, "h", 9, 0.5, 1, "b") for r in got), name
        if name in ("substring_dedup", "decontamination", "encoding"):
            assert len(got) == len(rows), name
        if name == "near_dedup":  # the three empty texts are one group, the two equal ones another
            assert len(got) == 3
        if name in ("quality", "near_dedup", "decontamination", "encoding"):
            assert {r.text for r in got} <= set(texts), name

"""Operator 4, SimHash near-dedup by a byte-position inverted index.

Two 64-bit fingerprints that differ in at most 2 bits share at least 6 of their
8 positional bytes. Lists of single bytes would hold 1/256 of the corpus each,
and tallying pairs over them is quadratic; so a posting names six positions and
their bytes at once (28 of them a fingerprint). A pair reaches the guaranteed
count of 6 exactly if it meets in a posting: s shared bytes meet in
C(s, 6) = 1, 7 or 28 postings for s = 6, 7, 8. A posting leaves 16 bits free, so
its list has at most 65,536 distinct fingerprints whatever the corpus.

Equal fingerprints are collapsed first. Within a list the pairs' shared bytes
are tallied and their bits verified; what leaves a list is one edge from each
fingerprint to the smallest of its linked group, not the pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.llm import textarrays as ta
from pos360.llm.tables import packed, partitions, pieces, read_table, written

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BYTES = 8
_PAIRWISE = 256  # lists up to this length are compared pair by pair
_TALLY_CHUNK = 1 << 15


def shingle_hashes(column, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, offsets by text); fewer than k words make one shingle, none makes none."""
    buf, off = ta.column_bytes(column)
    buf = ta.ASCII_LOWER[buf]
    start, end, words = ta.words(buf, off, ta.SPACE_SEPARATORS)
    length = end - start
    to = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length + 1, out=to[1:])
    joined = np.full(int(to[-1]), 0x20, np.uint8)
    place = np.ones(int(to[-1]), bool)
    place[to[1:] - 1] = False
    joined[place] = buf[:-8][ta.mark_runs(len(buf) - 8, start, end)]
    n = np.diff(words)
    shingles = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(shingles, out=at[1:])
    text = ta.row_of(at, int(at[-1]))
    first = np.arange(at[-1]) - at[text] + words[text]
    last = np.minimum(first + k, words[1:][text])
    line, h = joined.tobytes(), xxhash.xxh64_intdigest
    found = [h(line[a:b], SEED) for a, b in zip(to[first].tolist(), (to[last] - 1).tolist())]
    return np.array(found, np.uint64), at


def fingerprints_of(column, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprint of each text: bit b is set if over half of its shingles' hashes have it."""
    h, at = shingle_hashes(column, k)
    out = np.zeros(len(at) - 1, np.uint64)
    size = np.diff(at)
    full = np.flatnonzero(size)
    ones = np.zeros((len(full), 64), np.int64)
    begin = 0
    while begin < len(full):
        # Whole texts of about one chunk of shingles; a longer text is tallied in pieces.
        stop = max(begin + 1, int(np.searchsorted(at[full], at[full[begin]] + _TALLY_CHUNK)))
        a, b = int(at[full[begin]]), int(at[full[stop - 1] + 1])
        if stop == begin + 1:
            for x in range(a, b, _TALLY_CHUNK):
                ones[begin] += np.unpackbits(h[x : min(b, x + _TALLY_CHUNK)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            bits = np.unpackbits(h[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[begin:stop] = np.add.reduceat(bits, at[full[begin:stop]] - a, axis=0, dtype=np.int32)
        begin = stop
    packed = np.packbits(2 * ones > size[full][:, None], axis=1, bitorder="little")
    out[full] = packed.view(np.uint64).ravel() if len(full) else 0
    return out


def with_fingerprint(docs: DataFrame, k: int = SHINGLE_WORDS, name: str = "fingerprint") -> DataFrame:
    """docs and a long column of their fingerprints."""
    schema = T.StructType([*docs.schema, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fingerprints_of(b["text"], k).view(np.int64))], [*b.schema.names, name])

    return docs.mapInArrow(run, schema)


_FLIPS = np.array([0, *(1 << i for i in range(16)), *((1 << i) | (1 << j) for i, j in combinations(range(16), 2))], np.int64)


def local_groups(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Index of the smallest fingerprint linked to each, within one ascending posting list."""
    n, need = len(prints), BYTES - max_bits
    if n <= _PAIRWISE or max_bits > 2:
        a, b = np.triu_indices(n, 1)
        differ = prints[a] ^ prints[b]
        shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        keep = (shared >= need) & (np.bitwise_count(differ) <= max_bits)
        a, b = a[keep], b[keep]
    else:
        # Only two bytes vary: each value's neighbours are looked up, so no pairs are made.
        differ = np.bitwise_or.reduce(prints ^ prints[0])
        free = [i for i in range(BYTES) if (int(differ) >> (8 * i)) & 255]
        value = sum(((prints >> np.uint64(8 * i)) & np.uint64(255)).astype(np.int64) << (8 * j) for j, i in enumerate(free))
        place = np.full(1 << 16, -1, np.int64)
        place[value] = np.arange(n)
        flips = _FLIPS[[int(f).bit_count() <= max_bits for f in _FLIPS]][1:]
        to = place[value[:, None] ^ flips]
        a, j = np.nonzero(to >= 0)
        b = to[a, j]
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a > b: within every posting list, each distinct fingerprint and the smallest of its linked group."""
    keep = BYTES - max_bits
    masks = [sum(0xFF << (8 * i) for i in chosen) for chosen in combinations(range(BYTES), keep)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posting = F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")) for m in signed]))
    lists = (
        prints.select("fingerprint").repartition(partitions(prints.sparkSession)).select("fingerprint", posting.alias("positions", "bytes"))
        .groupBy("positions", "bytes")
        .agg(F.collect_list("fingerprint").alias("prints"))
        .where(F.size("prints") > 1)
        .select("prints")
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            source, target = [], []
            off = np.asarray(batch["prints"].offsets)
            values = np.asarray(batch["prints"].values)
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                one = np.sort(values[a:b].view(np.uint64))
                group = local_groups(one, max_bits)
                linked = np.flatnonzero(group != np.arange(len(one)))
                source.append(one[linked].view(np.int64))
                target.append(one[group[linked]].view(np.int64))
            if source:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(source), pa.int64()), pa.array(np.concatenate(target), pa.int64())], ["a", "b"])

    return lists.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of the edges (a, b).

    Each round takes the smallest root among the neighbours, then the root's
    root, and is written to the shared folder. Rounds grow with the logarithm of
    the longest chain; the count of changed nodes ends them."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("near"))
        seen = roots.join(near, roots["node"] == near["a"]).select("node", F.col("root").alias("was"), F.least("root", "near").alias("now"))
        up = roots.select(F.col("node").alias("now"), F.col("root").alias("top"))
        new = written(seen.join(up, "now").select("node", "was", F.least("now", "top").alias("root")), "roots")
        if new.where("root <> was").isEmpty():
            return new.select("node", "root")
        roots = new.select("node", "root")


def groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint) rows with component_id, the smallest id reachable over links.

    Rows whose fingerprint nobody shares or links to do not travel: their own id is the answer."""
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "fingerprints")
    rooted = components(links(distinct, max_bits))
    known = distinct.join(rooted, distinct["fingerprint"] == rooted["node"], "left").withColumn("top", F.coalesce("root", "fingerprint")).where((F.col("copies") > 1) | F.col("root").isNotNull())
    smallest = known.groupBy("top").agg(F.min("least").alias("component_id"))
    of_print = known.join(smallest, "top").select("fingerprint", "component_id", F.lit(True).alias("known"))
    return prints.join(of_print, "fingerprint", "left").withColumn("component_id", F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))).drop("known")


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: doc_id, fingerprint (hex), component_id.

    Defined cases: null or wordless texts have fingerprint zero and are linked
    like any other; fewer than k words are one shingle; null ids do not count as
    smallest (a group of null ids only has a null component_id); repeated ids
    and equal rows get a row each; an empty table gives none; other columns do
    not matter. The fingerprints are written once, so texts are hashed once."""
    prints = written(with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), k).drop("text"), "simhash")
    return groups(prints, max_bits).select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every group stays: that with the smallest id, the first read if ids repeat.

    With ids that are present and unique the rows to drop are known by id, and
    the texts are only filtered. Else the rows are numbered and written first,
    so that rows of one id can be told apart."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = written(with_fingerprint(ids, k).drop("text"), "simhash")
    counted = prints.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).head()
    if counted["rows"] == counted["ids"]:
        gone = groups(prints, max_bits).where("component_id <> doc_id").select(F.col("doc_id").alias("#gone"))
        return docs.join(gone, docs["doc_id"].cast("long") == gone["#gone"], "left_anti")
    numbered = written(with_fingerprint(packed(docs).withColumn("number", F.monotonically_increasing_id()), k).drop("text"), "simhash-docs")
    # Groups are numbered by their smallest row here: it is never null and never shared.
    rows = numbered.select(F.col("number").alias("doc_id"), F.col("row.doc_id").cast("long").alias("id"), "fingerprint")
    first = Window.partitionBy("component_id").orderBy(F.col("id").asc_nulls_last(), "doc_id")
    keep = groups(rows, max_bits).withColumn("rank", F.row_number().over(first)).where("rank = 1").select(F.col("doc_id").alias("number"))
    return numbered.join(keep, "number", "left_semi").select("row.*")


def op4_simhash_byte_index(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))

"""Operator 10, chat formatting by quotation linking.

Mail-style quotes ("> " before a line, nested by repeating it) tell which
message another one answers. Lines are parsed into quote levels, normalised and
hashed; a line at level k that also stands at level k - 1 of an earlier message
of the conversation was quoted from it, so that both a direct quote and the
nested quotes around it point at the same message. Where a line is not found as
it is (wrapped anew, or a sentence out of a longer line), the lines of its level
around it are joined to a passage, and the passage's shingles of words and short
sentences are looked for in the passages of earlier messages. The message
most of this points at is the one replied to; a line of a shingle's length or
more counts by its words, so that common short lines do not outvote it. A
message without any replies to the one before it, the first to none. Replies give each message its thread root and
depth, and the messages come out in reply order, as chat turns, without the
quotes that were found; quoted lines that stand nowhere before stay."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pos360.llm.tables import pieces, read_table, written

TURNS_TOGETHER = 256  # turns of a key that are looked at in one window; a busier key is split by turn
_QUOTED = r"^[ \t]*>"
_MARKS = r"^[ \t]*(>[ \t]?)+"
_ATTRIBUTION = re.compile(r"(wrote|writes|schrieb|a écrit|escribió)[ \t]*:[ \t]*$", re.IGNORECASE)
_BREAK = "\r?\n"
SHINGLE = 4  # words
#: Letters of scripts without spaces are words of their own; white space in lines is normalised already.
_SCRIPTS = "぀-ヿ㐀-鿿가-힯"
_WORD = f"[{_SCRIPTS}]|[^ {_SCRIPTS}]+"
_ENDS = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, _MARKS, "")), r"\s+", " "))


def _key(level: Column, line_hash: Column) -> Column:
    return F.xxhash64(level, line_hash)


def line_keys(text: Column) -> Column:
    """Key of each line that quotes something, null for the others; null for a text that quotes nothing."""
    def key(line: Column) -> Column:
        return F.when(line.rlike(_QUOTED) & (_normal(line) != ""), _key(_level(line), F.xxhash64(_normal(line))))

    return F.when(text.rlike("(?m)" + _QUOTED), F.transform(F.split(text, _BREAK), key))


def own_text(text: str, keys: list[int | None] | None, found: list[int] | None) -> str:
    """The text without the quoted lines whose keys were found, the attribution
    lines right before them, and quote marks without text but between lines that stay."""
    lines = re.split(_BREAK, text)
    if keys and found:
        found, marks = set(found), [re.match(_QUOTED, x) for x in lines]
        stays = [k not in found if k is not None else None if m else True for k, m in zip(keys, marks)]
        near = False
        for i, (stay, mark) in enumerate(zip(stays, marks)):  # bare marks: first as the line before, then as the line after
            near = near if mark and stay is None else bool(mark and stay)
            if stay is None:
                stays[i] = near
        near = False
        for i in range(len(lines) - 1, -1, -1):
            if marks[i] and keys[i] is None:
                stays[i] = stays[i] and near
            else:
                near = bool(marks[i] and stays[i])
        gone = [bool(m) and not s for m, s in zip(marks, stays)] + [False]
        lines = [x for i, x in enumerate(lines) if not gone[i] and not (gone[i + 1] and _ATTRIBUTION.search(x))]
    return "\n".join(lines).strip(" \t\n\x0b\f\r")


def passages(levels: list[int], bodies: list[str]) -> Iterator[tuple[int, list[str], list[int]]]:
    """(level, words, line of each word) of each run of lines of one level; lines without text do not end a run."""
    at, words, lines = -1, [], []
    for i, (level, body) in enumerate(zip(levels, bodies)):
        if not body:
            continue
        if level != at:
            if words:
                yield at, words, lines
            at, words, lines = level, [], []
        found = re.findall(_WORD, body)
        words += found
        lines += [i] * len(found)
    if words:
        yield at, words, lines


def units(words: list[str], level: int) -> Iterator[tuple[int, int, int]]:
    """(hash, start, end) of a passage's shingles and of its sentences that are shorter than these."""
    def unit(start: int, end: int) -> tuple[int, int, int]:
        h = xxhash.xxh64_intdigest(" ".join(words[start:end]), level)
        return h - (h >> 63 << 64), start, end

    for i in range(len(words) - SHINGLE + 1):
        yield unit(i, i + SHINGLE)
    start = 0
    for i, word in enumerate(words):
        if i + 1 == len(words) or _ENDS.search(word):
            if i + 1 - start < SHINGLE:
                yield unit(start, i + 1)
            start = i + 1


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of the wanted levels of each message, and those of its own quotes that touch a missing line."""
    for b in pieces(batches):
        out = {c: [] for c in ("conv_id", "turn", "level", "hash", "n", "owns")}
        for r in b.drop_columns(["text"]).to_pylist():
            wanted, missing = set(r["wanted"]), set(r["missing"] or ())
            holds, quotes = set(), {}
            for level, words, lines in passages(r["levels"], r["bodies"]):
                if level in wanted:
                    holds.update((level, h) for h, _, _ in units(words, level))
                lost = [r["keys"][i] in missing for i in lines] if level and missing else []
                if any(lost):
                    for h, start, end in units(words, level - 1):
                        if any(lost[start:end]):
                            quotes[level - 1, h] = quotes.get((level - 1, h), 0) + 1
            for (level, h), n, owns in [*((x, 0, True) for x in holds), *((x, n, False) for x, n in quotes.items())]:
                for c, v in zip(out, (r["conv_id"], r["turn"], level, h, n, owns)):
                    out[c].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))], list(out))


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the missing lines that matched units cover with all their words."""
    for b in pieces(batches):
        out = []
        for r in b.drop_columns(["text"]).to_pylist():
            missing, matched, keys = set(r["missing"]), set(r["matched"]), set()
            for level, words, lines in passages(r["levels"], r["bodies"]):
                if not level:
                    continue
                open_words = bytearray(b"\x01") * len(words)
                for h, start, end in units(words, level - 1):
                    if h in matched:
                        open_words[start:end] = bytes(end - start)
                short = {i for i, o in zip(lines, open_words) if o}
                keys |= {r["keys"][i] for i in lines if i not in short}
            out += [(r["conv_id"], r["turn"], k) for k in keys & missing]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)] if out else [pa.array([], pa.int64())] * 3, ["conv_id", "turn", "key"])


def passage_links(messages: DataFrame, lost: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For the quoted lines that were not found as they are (conv_id, turn, level
    they should stand at, key): votes of their passages (conv_id, turn, before,
    votes), and the lines found in them (conv_id, turn, key).

    Only conversations with such lines are read again, and of them the levels that these are looked for at."""
    wanted = lost.groupBy("conv_id").agg(F.collect_set("level").alias("wanted"), F.max("turn").alias("last"))
    missing = lost.groupBy("conv_id", "turn").agg(F.collect_set("key").alias("missing"))
    lines = F.split("text", _BREAK)
    heard = written(
        messages.select("conv_id", "turn", "text").join(wanted, "conv_id").where("turn <= last").drop("last").join(missing, ["conv_id", "turn"], "left")
        .withColumns({"keys": line_keys(F.col("text")), "levels": F.transform(lines, _level), "bodies": F.transform(lines, _normal)}),
        "heard",
    )
    all_units = heard.mapInArrow(_units, "conv_id long, turn long, level int, hash long, n long, owns boolean")
    found = written(last_before(all_units, ["conv_id", "level", "hash"]).where("not owns and before is not null").select("conv_id", "turn", "hash", "n", "before"), "units")
    votes = found.groupBy("conv_id", "turn", "before").agg(F.sum("n").alias("votes"))
    matched = found.groupBy("conv_id", "turn").agg(F.collect_set("hash").alias("matched"))
    keys = heard.where("missing is not null").join(matched, ["conv_id", "turn"]).mapInArrow(_covered, "conv_id long, turn long, key long").distinct()
    return votes, keys


def last_before(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows (keys, turn, owns) with `before`: the largest turn below the row's own, among rows of its keys that own.

    Keys are looked at in stretches of turns; what a stretch inherits comes from
    one row per stretch, so a busy key is not one window."""
    cut = rows.withColumn("stretch", F.floor(F.col("turn") / TURNS_TOGETHER))
    owner = F.when(F.col("owns"), F.col("turn"))
    inside = Window.partitionBy(*keys, "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    per = cut.groupBy(*keys, "stretch").agg(F.max(owner).alias("top")).withColumn("inherited", F.max("top").over(earlier)).drop("top")
    return cut.withColumn("near", F.max(owner).over(inside)).join(per, [*keys, "stretch"]).withColumn("before", F.coalesce("near", "inherited")).drop("near", "inherited", "stretch")


def replies(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, link, n_quoted, n_linked, found: keys of the linked lines) of every distinct message."""
    messages = messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    lines = messages.select(
        "conv_id", "turn", F.explode(F.split("text", _BREAK)).alias("line")
    ).select("conv_id", "turn", _level(F.col("line")).alias("level"), _normal(F.col("line")).alias("line")).where("line <> ''")
    words = F.when(F.col("level") > 0, F.regexp_count("line", F.lit(_WORD))).otherwise(0)
    hashed = lines.select("*", words.alias("words")).groupBy("conv_id", "turn", "level", F.xxhash64("line").alias("hash")).agg(F.count(F.lit(1)).alias("n"), F.max("words").alias("words"))
    quoting = hashed.where("level > 0").select("conv_id", (F.col("level") - 1).alias("level"), "hash", "turn", "n", "words", F.lit(False).alias("owns"))
    # Only lines that some message of the conversation quotes need be looked at; the same line may hold and be quoted.
    wanted = quoting.select("conv_id", "level", "hash").distinct()
    owning = hashed.join(wanted, ["conv_id", "level", "hash"], "left_semi").select("conv_id", "level", "hash", "turn", F.lit(0).cast("long").alias("n"), F.lit(0).alias("words"), F.lit(True).alias("owns"))
    linked = written(last_before(quoting.unionByName(owning), ["conv_id", "level", "hash"]).where("not owns").withColumn("key", _key(F.col("level") + 1, F.col("hash"))), "quoted")
    more, covered = passage_links(messages, linked.where("before is null").select("conv_id", "turn", "level", "key"))
    linked = linked.join(covered.withColumn("covered", F.lit(True)), ["conv_id", "turn", "key"], "left")
    there = F.col("before").isNotNull() | F.col("covered").isNotNull()
    quoted = linked.groupBy("conv_id", "turn").agg(F.sum("n").alias("n_quoted"), F.sum(F.when(there, F.col("n")).otherwise(0)).alias("n_linked"), F.collect_set(F.when(there, F.col("key"))).alias("found"))
    weight = F.when(F.col("words") < SHINGLE, 1).otherwise(F.col("words"))
    votes = linked.where("before is not null").select("conv_id", "turn", "before", (F.col("n") * weight).alias("votes")).unionByName(more).groupBy("conv_id", "turn", "before").agg(F.sum("votes").alias("votes"))
    best = votes.groupBy("conv_id", "turn").agg(F.max(F.struct("votes", "before")).alias("best")).select("conv_id", "turn", F.col("best.before").alias("quoted_turn"))
    turns = messages.select("conv_id", "turn", F.lit(True).alias("owns")).distinct()
    return (
        last_before(turns, ["conv_id"])
        .join(quoted, ["conv_id", "turn"], "left")
        .join(best, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", F.coalesce("quoted_turn", "before").alias("parent_turn"),
            F.when(F.col("quoted_turn").isNotNull(), "quote").when(F.col("before").isNotNull(), "turn").otherwise("root").alias("link"),
            F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "found",
        )
    )


def threads(links: DataFrame) -> DataFrame:
    """links with root_turn and reply_depth, by pointer jumping.

    Rounds grow with the logarithm of the deepest thread, and a message leaves
    them as soon as it points at a root, so one deep thread does not make all
    others travel again."""
    reply = F.col("parent_turn").isNotNull()
    jump = written(links.select("conv_id", "turn", F.coalesce("parent_turn", "turn").alias("up"), reply.cast("int").alias("steps"), (~reply).alias("done")), "threads")
    while not jump.where("not done").isEmpty():
        above = jump.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("top"), F.col("steps").alias("more"), F.col("done").alias("ends"))
        moved = jump.where("not done").join(above, ["conv_id", "up"]).select("conv_id", "turn", F.col("top").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ends").alias("done"))
        jump = written(jump.where("done").unionByName(moved), "threads")
    return links.join(jump.select("conv_id", "turn", F.col("up").alias("root_turn"), F.col("steps").alias("reply_depth")), ["conv_id", "turn"])


def link_quotes(messages: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, role, parent_turn, link (quote, turn or root),
    root_turn, reply_depth, n_quoted and n_linked (quoted lines, and those found),
    text (without the quoted lines that were found) and formatted (a chat turn),
    ranged and sorted by conversation, root, depth and parent, so that a reply
    follows its message.

    Defined cases: null text is empty; a null role is written as the empty
    string; a row with a null conversation or turn links to nothing and is its
    own root; rows that share conversation and turn are one message to the
    links and get a row each; text that quotes nothing known falls back to the
    turn before; quoted lines that no earlier message has (a Python session, a
    quote from elsewhere) stay in the text with their marks, as does the line
    that says who wrote them, and so does a line of which only some words are
    found, though these count for the link; an empty table gives no row; other columns do not
    matter."""
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found = threads(written(replies(rows), "replies"))
    order = ["conv_id", "root_turn", "reply_depth", "parent_turn", "turn"]
    ordered = (
        rows.join(found, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "parent_turn", F.coalesce("link", F.lit("root")).alias("link"), F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("reply_depth", F.lit(0)).alias("reply_depth"), F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"), F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
            "text", "found",
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    names = [c for c in ordered.columns if c not in ("text", "found")]
    schema = ordered.select(*names, "text", F.lit("").alias("formatted")).schema

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches):
            text = [own_text(*x) for x in zip(b["text"].to_pylist(), b["keys"].to_pylist(), b["found"].to_pylist())]
            formatted = [f"<|{r}|>\n{t}\n<|end|>\n" for r, t in zip(b["role"].to_pylist(), text)]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in names), pa.array(text, pa.string()), pa.array(formatted, pa.string())], [*names, "text", "formatted"])

    return ordered.withColumn("keys", line_keys(F.col("text"))).mapInArrow(run, schema)


def op10_quotation_threads(spark, sf_dir: str) -> DataFrame:
    return link_quotes(read_table(spark, sf_dir, "conversations"))

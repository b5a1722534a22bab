"""Operator 10: threads whose replies are known, and a brute-force version."""

import random
import re

from pos360.llm import quote_linking as ql

SCHEMA = "conv_id long, turn long, role string, text string, stretch string, hash long"


def frame(spark, messages):
    return spark.createDataFrame([(c, t, r, x, "clash", 1) for c, t, r, x in messages], SCHEMA)


def brute(messages):
    """(conv_id, turn) -> (parent, link, root, depth, n_quoted, n_linked)."""
    def parse(text):
        out = []
        for line in re.split("\r?\n", text or ""):
            marks = re.match(r"[ \t]*(>[ \t]?)+", line)
            body = line[marks.end() :] if marks else line
            body = re.sub(r"\s+", " ", body.lower()).strip()
            if body:
                out.append((marks[0].count(">") if marks else 0, body))
        return out

    lines = {}
    for c, t, _, x in messages:
        if c is not None and t is not None:
            lines.setdefault((c, t), []).extend(parse(x))
    out = {}
    for c, t in sorted(lines):
        before = [u for d, u in lines if d == c and u < t]
        votes, n_linked = {}, 0
        for level, body in lines[c, t]:
            if level and (found := [u for u in before if (level - 1, body) in lines[c, u]]):
                votes[max(found)] = votes.get(max(found), 0) + 1
                n_linked += 1
        parent = max(votes, key=lambda u: (votes[u], u)) if votes else max(before, default=None)
        root, depth = (t, 0) if parent is None else (out[c, parent][2], out[c, parent][3] + 1)
        out[c, t] = (parent, "quote" if votes else "root" if parent is None else "turn", root, depth, sum(1 for level, _ in lines[c, t] if level), n_linked)
    return out


def test_known_thread(spark):
    m = [
        (1, 0, "user", "Hello there.\nHow do I sort?"),
        (1, 1, "assistant", "> How do I sort?\nUse sorted()."),
        (1, 2, "user", "Another topic entirely."),
        (1, 3, "user", "On Monday, A wrote:\n> Use sorted().\n>> How do I  SORT?\nThanks"),
        (1, 4, "assistant", "> Another topic entirely.\nok"),
        (1, 600, "user", "> > How do I sort?\nfar"),
    ]
    out = {r.turn: r for r in ql.link_quotes(frame(spark, m)).collect()}
    assert {t: r.parent_turn for t, r in out.items()} == {0: None, 1: 0, 2: 1, 3: 1, 4: 2, 600: 1}
    assert out[3].text == "Thanks" and out[3].formatted == "<|user|>\nThanks\n<|end|>\n" and out[3].reply_depth == 2


def test_random_threads(spark):
    rng = random.Random(4)
    messages = []
    for c in range(12):
        said = []
        for t in sorted(rng.sample(range(700), rng.randint(1, 12))):
            own = [rng.choice(["yes", "no", "maybe so", f"line {rng.randint(0, 9)}"]) for _ in range(rng.randint(0, 3))]
            quoted = [">" + rng.choice(["", " "]) + x for x in rng.choice(said).split("\n") if rng.random() < 0.8] if said and rng.random() < 0.7 else []
            text = "\n".join(quoted + own)
            said.append(text)
            messages.append((c, t, "user", text))
    want = brute(messages)
    out = ql.link_quotes(frame(spark, messages)).collect()
    assert {(r.conv_id, r.turn): (r.parent_turn, r.link, r.root_turn, r.reply_depth, r.n_quoted, r.n_linked) for r in out} == want


def test_one_long_conversation_with_a_common_line(spark):
    messages = [(1, t, "u", "> ok\nok" if t else "ok") for t in range(1200)]
    out = ql.link_quotes(frame(spark, messages)).collect()
    assert all(r.parent_turn == r.turn - 1 and r.reply_depth == r.turn for r in out if r.turn) and len(out) == 1200


def test_nulls_repeats_and_no_rows(spark):
    m = [(None, 0, "x", None), (2, None, None, "y"), (3, 7, "user", "only"), (3, 7, "user", "only")]
    out = ql.link_quotes(frame(spark, m))
    assert sorted((r.link, r.text, r.reply_depth) for r in out.collect()) == [("root", "", 0), ("root", "only", 0), ("root", "only", 0), ("root", "y", 0)]
    assert ql.link_quotes(frame(spark, m).where("false")).count() == 0


def test_replies_follow_their_messages(spark):
    m = [(1, t, "u", x) for t, x in enumerate(["a", "> a\nb", "> b\nc", "> a\nd"])]
    seen = set()
    for r in ql.link_quotes(frame(spark, m)).coalesce(1).collect():
        assert r.parent_turn is None or r.parent_turn in seen
        seen.add(r.turn)


def test_quoted_lines_that_stand_nowhere_before_stay(spark):
    m = [
        (1, 0, "user", "How do I set x?"),
        (1, 1, "assistant", "A wrote:\n> How do I set x?\n>\nSo:\n>>> x = 1\n>>>\n>>> x\n1\nB wrote:\n> Never set x.\n> How do I set x?\nDone."),
        (2, None, "user", "> lonely\nx"),
        (3, 0, "user", "> from elsewhere\r\n> and more\r\nmy view"),
    ]
    out = {(r.conv_id, r.turn): r for r in ql.link_quotes(frame(spark, m)).collect()}
    assert out[1, 1].text == "So:\n>>> x = 1\n>>>\n>>> x\n1\nB wrote:\n> Never set x.\nDone."
    assert out[1, 1].formatted == f"<|assistant|>\n{out[1, 1].text}\n<|end|>\n" and (out[1, 1].parent_turn, out[1, 1].n_quoted, out[1, 1].n_linked) == (0, 5, 2)
    assert out[2, None].text == "> lonely\nx" and out[3, 0].text == "> from elsewhere\n> and more\nmy view"


def test_quotes_wrapped_anew_and_in_part(spark):
    first = "The table is sorted by its key before it is written. I agree. Nobody has to sort it again, as far as I know."
    m = [
        (1, 0, "user", first + "\nthanks"),
        (1, 1, "assistant", "thanks"),
        (1, 2, "user", "Something else altogether."),
        (1, 3, "user", "> The table is sorted by its key\n> before it is written. I agree. Nobody has to sort it\n> again, as far as I know.\n> thanks\nWrapped."),
        (1, 4, "user", "> Nobody has to sort it again, as far as I know.\nOne sentence."),
        (1, 5, "user", "A wrote:\n> i  agree.\nShort."),
        (1, 6, "user", ">> The table is sorted\n>> by its key before it is written.\n> Wrapped.\nNested."),
        (1, 7, "user", "> The table is sorted by somebody else.\nChanged."),
        (2, 0, "user", first),
    ]
    out = {(r.conv_id, r.turn): r for r in ql.link_quotes(frame(spark, m)).collect()}
    assert {t: out[1, t].parent_turn for t in range(3, 8)} == {3: 0, 4: 0, 5: 0, 6: 3, 7: 0}
    assert [out[1, t].text for t in range(3, 8)] == ["Wrapped.", "One sentence.", "Short.", "Nested.", "> The table is sorted by somebody else.\nChanged."]
    assert [(out[1, t].n_quoted, out[1, t].n_linked) for t in range(3, 8)] == [(4, 4), (1, 1), (1, 1), (3, 3), (1, 0)]
    assert all(out[1, t].link == "quote" for t in range(3, 8)) and out[2, 0].link == "root"

from __future__ import annotations

import random
import re

from runledger.llm.quote_links import conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows):
    # Extra columns with names that the operator uses inside.
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as level", "'x' as passage", "2 as depth", "3 as hash")
    out = {}
    for r in conversations(df).collect():
        out.setdefault((r.conv_id, r.turn), []).append(
            (r.thread_id, r.parent_conv, r.parent_turn, r.depth, r.text))
    return out


def test_links_levels_and_threads(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\nThanks"),
        (1, 1, "assistant", "> How do I  SORT a list?\nUse sorted()."),
        (1, 2, "user", ">> How do I sort a list?\n> Use sorted().\nAnd down?"),
        (1, 3, "assistant", "No quote here."),
        (1, 4, "user", "> > Use sorted().\n> And down?\n> unknown\nYes"),
        # Another conversation quotes the first one.
        (7, 0, "user", "> No quote here.\nI saw this."),
        (7, 1, "assistant", "ok"),
        (9, 0, "user", "> I saw this.\nMe too"),
        # A quote of something later or never written links nothing.
        (0, 0, "user", "> Use sorted().\nearly"),
        (3, 0, "user", "alone"), (3, 1, "assistant", None),
        (4, 0, "user", ""), (None, 1, "user", "> alone\nx"),
        (5, None, "user", "> alone"),
    ]
    got = run(spark, rows)
    assert got[1, 0] == [(1, None, None, 0, "How do I sort a list?\nThanks")]
    assert got[1, 1] == [(1, 1, 0, 1, "Use sorted().")]
    assert got[1, 2] == [(1, 1, 1, 2, "And down?")]
    assert got[1, 3] == [(1, None, None, 0, "No quote here.")]
    assert got[1, 4] == [(1, 1, 2, 3, "Yes")]
    assert got[7, 0] == [(1, 1, 3, 1, "I saw this.")]
    assert got[7, 1] == [(1, None, None, 0, "ok")]
    assert got[9, 0] == [(1, 7, 0, 2, "Me too")]
    assert got[0, 0] == [(0, None, None, 0, "early")]
    assert got[3, 1] == [(3, None, None, 0, "")]
    assert got[4, 0] == [(4, None, None, 0, "")]
    assert got[None, 1] == [(None, None, None, 0, "x")]
    assert got[5, None] == [(5, None, None, 0, "")]


def test_parent_is_inferred_from_nested_levels(spark):
    """Turn 1 quotes nothing, but turn 2 shows what it answered."""
    rows = [(1, 0, "user", "first line of all"),
            (1, 1, "assistant", "second line of all"),
            (1, 2, "user", ">> first line of all\n> second line of all\nhm")]
    got = run(spark, rows)
    assert got[1, 1] == [(1, 1, 0, 1, "second line of all")]
    assert got[1, 2] == [(1, 1, 1, 2, "hm")]


def test_shared_passage_and_repeated_rows(spark):
    """Thousands may write a line; a quote joins to one message only."""
    rows = [(k, 0, "user", "hello there") for k in range(200)]
    rows += [(k, 1, "assistant", "> hello there\nhi") for k in range(200)]
    rows += [(500, 0, "user", "> hello there\nx")] * 3
    got = run(spark, rows)
    assert all(got[k, 1] == [(k, k, 0, 1, "hi")] for k in range(200))
    assert got[500, 0] == [(0, 0, 0, 1, "x")] * 3


def test_original_wrote_most_lines_of_all_messages(spark):
    abc = ["alpha line", "beta line", "gamma line"]
    quote = "\n".join("> " + x for x in abc)
    rows = [(k + 1, 0, "user", x) for k, x in enumerate(abc)]
    rows += [(5, 0, "user", "\n".join(abc)), (6, 0, "user", "\n".join(abc)),
             (9, 0, "user", quote),
             # The own conversation wrote fewer of the lines.
             (11, 0, "user", abc[0]), (11, 1, "user", quote),
             # Turn 3 repeats one of the two lines that turn 1 wrote.
             (20, 1, "user", "delta line\nepsilon line"),
             (20, 3, "user", "delta line"),
             (20, 5, "user", "> delta line\n> epsilon line")]
    got = run(spark, rows)
    assert got[9, 0][0][:3] == (5, 5, 0)
    assert got[11, 1][0][:3] == (5, 5, 0)
    assert got[20, 5][0][:3] == (20, 20, 1)
    assert got[3, 0][0][0] == 3


def test_long_chain_and_empty_table(spark):
    rows = [(1, 0, "user", "line 0")] + [
        (1, k, "user", f"> line {k - 1}\nline {k}") for k in range(1, 40)]
    got = run(spark, rows)
    assert all(got[1, k][0][3] == k for k in range(40))
    assert run(spark, []) == {}


def test_million_marks(spark):
    rows = [(1, 0, "user", "a line\nanother"),
            (1, 1, "user", "> a line\n" + ">" * 1_000_000 + " a line\nx"),
            (1, 2, "user", "> " * 300_000 + "\n" + "y" * 500_000)]
    got = run(spark, rows)
    assert got[1, 1] == [(1, 1, 0, 1, "x")]
    assert got[1, 2][0][4] == "y" * 500_000


def plain(rows):
    """The same by loops over all messages: (conv, turn) to (thread, parent,
    depth)."""
    def passages(text):
        for line in re.split(r"\r?\n", text or ""):
            marks = re.match(r"[\s>]*>", line)
            body = line[marks.end():] if marks else line
            body = re.sub(r"\s+", " ", body).strip(" ").lower()
            if re.search(r"[^\W_]", body):
                yield marks.group().count(">") if marks else 0, body
    wrote, blocks = {}, {}
    for conv, turn, _, text in rows:
        for level, body in passages(text):
            if level:
                blocks.setdefault((conv, turn, level), set()).add(body)
            else:
                wrote.setdefault((conv, turn), set()).add(body)
    best = {}
    for (conv, turn, level), block in blocks.items():
        found = []
        for (c, t), lines in wrote.items():
            n = len(lines & block)
            if n and c == conv and t < turn:
                found.append(((n, 1, c, t), (c, t)))
            elif n and c < conv:
                found.append(((n, 0, -c, -t), (c, t)))
        if found:
            best[conv, turn, level] = max(found)[1]
    parent = {(c, t): o for (c, t, level), o in best.items() if level == 1}
    inferred = {}
    for (c, t, level), o in best.items():
        above = best.get((c, t, level + 1))
        if above and above < o and o not in parent:
            inferred[o] = max(above, inferred.get(o, above))
    parent |= inferred
    thread = {c: c for c, *_ in rows}
    for _ in thread:
        for (c, _t), (o, _o) in parent.items():
            thread[c] = thread[o] = min(thread[c], thread[o])

    def depth(m):
        return 1 + depth(parent[m]) if m in parent else 0
    return {(c, t): (thread[c], *parent.get((c, t), (None, None)),
                     depth((c, t))) for c, t, *_ in rows}


def test_equals_loops_on_random_conversations(spark):
    rnd = random.Random(5)
    lines = [f"Line {k} of   some talk" for k in range(40)] + ["--", "", "é"]
    rows, said = [], []
    for conv in range(60):
        for turn in range(rnd.randrange(1, 6)):
            text = [rnd.choice(lines) for _ in range(rnd.randrange(4))]
            for _ in range(rnd.randrange(3)):
                if said:
                    # Quote a message with what it quotes, now and then
                    # losing a line or changing blanks and case.
                    for line in rnd.choice(said[-30:]).split("\n"):
                        if rnd.random() < 0.8:
                            mark = rnd.choice([">", "> ", ">  "])
                            text.append(mark + rnd.choice(
                                [line, line.upper(), line + "  "]))
            said.append("\n".join(text))
            rows.append((conv, turn, "user", said[-1]))
    want = plain(rows)
    got = run(spark, rows)
    assert {k: v[0][:4] for k, v in got.items()} == want
    assert sum(v[3] > 1 for v in want.values()) > 20
    assert sum(v[0] != c for (c, _), v in want.items()) > 20

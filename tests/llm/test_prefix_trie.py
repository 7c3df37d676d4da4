from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from runledger.llm import prefix_trie as module
from runledger.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
           "n_leaves", "saved_tokens", "ends_sha256"]


def result(spark, rows):
    # Extra columns with names that the operator uses inside.
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as depth", "'x' as part", "2 as size", "3 as place",
        "4 as weight", "5 as block")
    return sorted(map(tuple, prefix_trie(df).select(*COLUMNS).collect()),
                  key=str)


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{role}\0{text}".encode()).hexdigest()
            convs.setdefault(c, []).append(
                ((turn is not None, turn or 0, tie), (role, text)))
    convs = {c: [t for _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(convs.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    out = []
    for seq, members in nodes.items():
        under = [s for s in nodes if s[:len(seq)] == seq]
        ends = sorted(c for c in members if built[c] == seq)
        out.append((
            min(members), len(seq), min(nodes[seq[:-1]]) if seq else None,
            len(members), sum(len(s) == len(seq) + 1 for s in under),
            sum(not any(len(x) == len(s) + 1 and x[:-1] == s for x in under)
                for s in under),
            sum((len(nodes[s]) - 1) * (len(s[-1][1]) if s else 0)
                for s in under),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["a", "bb", "", "ä€😀", None, "long " * 40]
    rows = []
    for c in list(range(0, 60)) + [100, 101, 150, 231, 299, -3, -100, -142]:
        n = rng.randint(1, 7)
        first = rng.choice([None, 0, 3])
        for k in range(n):
            turn = first if k == 0 else (first or 0) + k
            rows.append((c, turn, rng.choice(["user", None, "tool"]),
                         rng.choice(words)))
            if rng.random() < 0.1:
                rows.append(rows[-1])            # a tie and a repeated row
    rows += [(300 + k, t, "user", f"same {t}") for k in range(1, 40)
             for t in range(6, 9)]               # many copies, no base
    rows += [(400, 0, "x", "one"), (400, 0, "x", "two"), (400, 0, "y", "one"),
             (None, 0, "user", "no id"), (None, 1, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,chunk", [
    (1, module.BLOCK, module.CHUNK_IDS), (2, 2, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, block, chunk):
    """Blocks of two turns and pieces of three ids cross many borders."""
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "CHUNK_IDS", chunk)
    rows = corpus(seed)
    assert result(spark, rows) == brute(rows)


def test_one_long_conversation(spark, monkeypatch):
    """A conversation with most of all turns, and one that shares its start."""
    monkeypatch.setattr(module, "BLOCK", 64)
    rows = [(0, t, "user", f"turn {t}") for t in range(700)]
    rows += [(7, t, "user", f"turn {t}") for t in range(500)]
    rows += [(100, 0, "user", "z" * 300_000)]
    got = {(r[0], r[1]): r for r in result(spark, rows)}
    assert len(got) == 1 + 700 + 1
    size = sum(len(f"turn {t}") for t in range(500))
    assert got[0, 0][3:7] == (3, 2, 2, size)
    assert got[0, 500][3:7] == (2, 1, 1, len("turn 499"))
    assert got[0, 501][3:7] == (1, 1, 1, 0)
    assert got[0, 500][7] == hashlib.sha256(b"7").hexdigest()
    assert got[0, 0][7] == hashlib.sha256(b"").hexdigest()


def test_empty_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, 1, "user", "x")]) == []
    # All turns of 106 belong to its absent start: it ends at the root.
    h = zlib.crc32(b"106") % 6
    rows = [(106, k, "user", "x") for k in range(h)]
    assert result(spark, rows) == brute(rows)

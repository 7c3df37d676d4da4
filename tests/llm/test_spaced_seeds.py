from __future__ import annotations

import random
import re

from runledger.llm.spaced_seeds import (
    MASKS, decontaminate, leaks, length_class)
from tests.llm.conftest import EDGE

RNG = random.Random(3)
VOCAB = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(1, 6)))
         for _ in range(400)]


def words(n):
    return [RNG.choice(VOCAB) for _ in range(n)]


def brute(docs, items, share=0.8):
    """All alignments of every window of 50 words, by comparing them all."""
    out = set()
    for d, t in docs:
        w = re.findall(r"\w+", (t or "").lower())
        for i, text in items:
            v = re.findall(r"\w+", (text or "").lower())
            for at in range(0, max(1, len(v) - 25), 25):
                win = v[at:at + 50]
                if len(win) < 5:
                    continue
                for s in range(-len(win), len(w)):
                    eq = sum(1 for k, x in enumerate(win)
                             if 0 <= s + k < len(w) and w[s + k] == x)
                    if eq >= share * len(win):
                        out.add((d, i))
    return out


def test_equals_brute_force(spark, make_docs):
    items = [(k, " ".join(words(n))) for k, n in enumerate(
        [14, 30, 50, 51, 80, 130, 8, 5, 3, 9])] + [(90, None), (91, "")]
    docs = list(EDGE)
    for k in range(40):
        i, t = items[k % 10]
        v = t.split()
        for _ in range(k // 10 * len(v) // 20):   # some substituted words
            v[RNG.randrange(len(v))] = "other"
        lead = words(RNG.randint(0, 60))
        docs.append((100 + k, " ".join(lead + v + words(20)).upper()))
        docs.append((200 + k, " ".join(words(120))))
    docs += [(300, " ".join(words(9000)) + " " + items[2][1] + " tail"),
             (300, items[1][1]), (None, items[2][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(make_docs(docs), bench)
           .collect()}
    want = brute(docs, items)
    exact = {(d, i) for d, i in want if (d or 0) < 110 or (d or 0) >= 300}
    assert got <= want and exact <= got
    assert len(got) >= 0.95 * len(want)   # seeds may miss heavy substitution
    out = decontaminate(make_docs(docs), bench)
    bad = {d for d, _ in got}
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted(
        (d for d, _ in docs if d not in bad), key=str)


def any_stretch(docs, items, share=0.8):
    """Every stretch of 20 words or more, or the whole item, everywhere."""
    out = set()
    for d, t in docs:
        w = t.lower().split()
        for i, text in items:
            v = text.split()
            least = min(20, len(v))
            for s in range(-len(v), len(w)):
                sums = [0]
                for k, x in enumerate(v):
                    sums.append(sums[-1] + (
                        0 <= s + k < len(w) and w[s + k] == x))
                if sums[-1] >= share * least and any(
                        sums[b] - sums[a] >= share * (b - a)
                        for a in range(len(v) - least + 1)
                        for b in range(a + least, len(v) + 1)):
                    out.add((d, i))
    return out


def test_excerpts_and_short_items_equal_brute_force(spark, make_docs):
    """Excerpts of 20 words and more from anywhere, and a fifth of the words
    substituted in any places, in items of 5 to 26 words."""
    items = [(n, " ".join(words(n))) for n in [*range(5, 27), 48, 100, 230]]
    text = dict(items)
    docs = []

    def add(v, subs=0):
        v = list(v)
        for k in RNG.sample(range(len(v)), subs):
            v[k] = "other"
        docs.append((len(docs), " ".join(words(25) + v + words(25))))

    add(text[100].split()[12:64])
    add(text[48].split()[5:42])
    for n in range(5, 27):
        for _ in range(6):
            add(text[n].split(), n // 5)
    for at in range(0, 211, 15):
        add(text[230].split()[at:at + 20], 4)
        add(text[230].split()[at:at + 20], 5)
    v = text[15].split()
    v[1] = v[5] = v[6] = "other"
    add(v)
    v = text[100].split()           # five together in every 20 words
    for k in (15, 35, 55, 75):
        v[k:k + 5] = ["other"] * 5
    add(v)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in leaks(make_docs(docs), bench)
           .collect()}
    want = any_stretch(docs, items)
    assert set(got) == want and (0, 100) in want and (1, 48) in want
    for (d, i), r in got.items():
        a = docs[d][1].split()[r.doc_start:r.doc_start + r.n_words]
        b = text[i].split()[r.item_start:r.item_start + r.n_words]
        assert r.n_equal == sum(x == y for x, y in zip(a, b))
        assert r.n_equal >= 0.8 * r.n_words


def test_masks_lose_no_choice_of_substituted_words():
    def untouched(masks, n, left, used=0):
        """Some seed is left for any ``left`` more substituted places."""
        for m in masks:
            for at in range(n - m[-1]):
                seed = sum(1 << at + o for o in m)
                if not seed & used:
                    return not left or all(
                        untouched(masks, n, left - 1, used | 1 << at + o)
                        for o in m)
        return False

    for n in [*range(5, 31), 35]:
        assert untouched(MASKS[length_class(n)], n, n // 5)


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert leaks(make_docs(EDGE), bench).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f")],
                                "item_id long, text string")
    assert leaks(make_docs([]), one).count() == 0

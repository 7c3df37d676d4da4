"""The pipeline's stages against a plain version of each decision."""

from __future__ import annotations

import random

import corpus_pipeline
from runledger.session import new_run_dir
from tests.llm.test_bm25_packing import check
from tests.llm.test_weak_quality import junk, prose

RNG = random.Random(21)


def grams(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} \
        if w else set()


def test_stages_keep_what_they_should(spark, make_docs):
    bench = [(k, prose(40)) for k in range(5)]
    clean = [(k, prose(RNG.randint(30, 200))) for k in range(120)]
    rows = list(clean)
    rows += [(300 + k, junk(k % 4)) for k in range(40)]
    rows += [(400 + k, clean[k][1]) for k in range(10)]        # exact copies
    near = {}
    for k in range(10, 30):                                    # near copies
        w = clean[k][1].split()
        if len(w) >= 60:
            w[len(w) // 2] = "altered"
            near[500 + k] = k
            rows.append((500 + k, " ".join(w)))
    for k in range(10):                                        # leaks
        rows.append((600 + k, prose(30) + " " + bench[k % 5][1]
                     + " " + prose(10)))
    rows += [(700, None), (701, ""), (None, prose(50)), (5, clean[5][1])]

    sf_dir = new_run_dir(spark, "pipeline-test")
    docs = make_docs(rows).cache()
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string") \
        .write.parquet(f"{sf_dir}/benchmark.parquet")

    kept = [(r.doc_id, r.text) for r in docs.collect()]
    frame = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, frame, sf_dir)
        assert out.columns == docs.columns
        path = new_run_dir(spark, f"stage{k}")
        out.write.parquet(path)
        frame = spark.read.parquet(path)
        got = [(r.doc_id, r.text) for r in frame.collect()]
        ids = {i for i, _ in got}
        if name == "quality_classifier":
            assert not any(300 <= (i or 0) < 340 for i in ids)
            assert {i for i, _ in clean} <= ids
        elif name == "exact_dedup":
            best = {}
            for i, t in kept:
                t = t or ""
                if t not in best or (i is not None and (
                        best[t] is None or i > best[t])):
                    best[t] = i
            assert sorted(got, key=str) == sorted(
                [(i, t) for t, i in best.items()], key=str) or sorted(
                [(i, t or "") for i, t in got], key=str) == sorted(
                [(i, t) for t, i in best.items()], key=str)
        elif name == "near_dedup":
            sets = {i: grams(t) for i, t in kept}
            for a, b in near.items():
                if a in sets and b in sets:
                    x, y = sets[a], sets[b]
                    alike = 100 * len(x & y) >= 80 * len(x | y)
                    assert (a not in ids) == alike and b in ids
            assert len(got) == len(kept) - sum(
                1 for a in near if a in sets and a not in ids)
        else:
            assert not any(600 <= (i or 0) < 610 for i in ids)
            assert len(got) == sum(
                1 for i, _ in kept if not 600 <= (i or 0) < 610)
        kept = got
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).collect()
    check(kept, pieces)

    # run() is the same chain.
    whole = corpus_pipeline.run(spark, sf_dir)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    total = {}
    for r in whole.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    want = {}
    for p in pieces:
        want[p.doc_id] = want.get(p.doc_id, 0) + p.length
    assert total == want and set(key) <= set(whole.columns)


def test_stages_decide_by_row(spark, make_docs):
    """Rows that share an id, or have none, are decided one by one."""
    bench = [(0, prose(40))]
    a, b, c, d = (prose(90) for _ in range(4))
    near_b = b.split()
    near_b[45] = "altered"
    near_b = " ".join(near_b)
    sf_dir = new_run_dir(spark, "pipeline-rows")
    spark.createDataFrame(bench, "item_id long, text string") \
        .write.parquet(f"{sf_dir}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        out = stages[name](spark, make_docs(rows), sf_dir)
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    def same(rows):
        return sorted(rows, key=str)

    good = [(k, prose(100)) for k in range(120)] + [
        (None, a), (None, b), (3, c), (3, c)]
    bad = [(300 + k, junk(k % 4)) for k in range(40)] + [
        (None, junk(k % 4)) for k in range(8)]
    assert run("quality_classifier", good + bad) == same(good)
    assert run("exact_dedup", [
        (5, a), (5, a), (3, a), (5, b), (9, b), (9, b), (None, c),
        (None, c), (None, d), (None, d), (4, d)]
    ) == same([(5, a), (9, b), (None, c), (4, d)])
    assert run("near_dedup", [
        (5, a), (5, near_b), (3, b), (None, c), (None, d)]
    ) == same([(5, a), (3, b), (None, c), (None, d)])
    leak = prose(20) + " " + bench[0][1]
    assert run("decontamination", [
        (None, leak), (None, a), (7, leak), (7, b), (8, c)]
    ) == same([(None, a), (7, b), (8, c)])


def test_stage_names_and_operators():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and len(set(names)) == 5
    assert corpus_pipeline.ORACLE_SQL is None

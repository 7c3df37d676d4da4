"""Flow maps of any size give the same flows; small ones need no join."""

from __future__ import annotations

import random

from runledger.operators import flows
from runledger.operators.flows import _joined_flow, classify_flow

SCHEMA = "ord int, pattern string, flow string"


def plain_flow(rules, v):
    hits = [] if v is None else sorted(
        (o, p.encode(), f or "") for o, p, f in rules
        if p is not None and p in v)
    if not hits:
        return "unknown-pipeline"
    o, p, _ = hits[0]
    return next(f for a, b, f in rules if a == o and b is not None
                and b.encode() == p)


def test_small_maps_both_ways(spark):
    rng = random.Random(5)
    vals = [None, ""] + ["".join(rng.choices("abÄ-", k=rng.randint(1, 9)))
                         for _ in range(150)]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    for n in (0, 1, 4, flows.RULES, flows.RULES + 1):
        rules, seen = [], set()
        while len(rules) < n:
            p = "".join(rng.choices("abÄ-", k=rng.randint(1, 5)))
            o = rng.randint(0, 5)
            if (o, p) not in seen:
                seen.add((o, p))
                rules.append((o, p, None if rng.random() < 0.2 else
                              f"{o}{p}"))
        if n == 4:
            rules += [(2, "", "any"), (0, None, "null pattern")]
        fm = spark.createDataFrame(rules, SCHEMA)
        want = sorted(((v, plain_flow(rules, v)) for v in vals), key=str)
        for way in (classify_flow(df, "v", fm), _joined_flow(
                df, "v", fm, "flow", "unknown-pipeline")):
            assert sorted(((r.v, r.flow) for r in way.collect()),
                          key=str) == want


def test_size_is_checked(spark):
    def plan(rules):
        df = spark.range(9).selectExpr("cast(id as string) as v")
        return classify_flow(df, "v", spark.createDataFrame(
            rules, SCHEMA))._jdf.queryExecution().toString()
    assert "Join" not in plan([(0, "1", "a"), (1, "2", "b")])
    assert "Join" in plan([(k, str(k), "f") for k in range(flows.RULES + 1)])
    assert "Join" in plan([(0, "x" * (flows.RULE_CHARS + 1), "long")])

from __future__ import annotations

import hashlib

import pytest

from runledger.llm.block_naming import deduplicate, exact_duplicates
from tests.llm.conftest import EDGE


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_bits,block", [(56, 4096), (56, 7), (2, 256)])
def test_equals_brute_force(make_docs, hash_bits, block):
    """Two hash bits make almost every name collide."""
    pairs = EDGE + [(100 + k, "block " * (k % 9) + "end" * (k % 4))
                    for k in range(60)]
    got = exact_duplicates(make_docs(pairs), block, hash_bits).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256)
                   for r in got], key=str) == brute(pairs)
    # One row of each group stays, repeated rows included.
    groups = {(r.text_sha256) for r in got}
    assert len([r for r in got if r.kept]) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_deduplicate_keeps_columns_and_one_row(make_docs):
    docs = make_docs(EDGE)
    out = deduplicate(docs)
    assert out.columns == docs.columns
    texts = [r.text or "" for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in EDGE})


def test_empty_table(make_docs):
    assert exact_duplicates(make_docs([])).count() == 0

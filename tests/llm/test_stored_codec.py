"""Tables between the steps of an operator, in a given codec."""

from __future__ import annotations

import os

from runledger.llm import suffix_names
from runledger.llm.common import stored


def test_stored_in_a_codec(spark):
    df = spark.range(1000).selectExpr("id", "repeat('text ', 50) as text")
    back = stored(df, "codec", suffix_names.CODEC)
    files = [os.path.basename(f) for f in back.inputFiles()]
    assert files and all(".zstd." in f for f in files)
    assert sorted(map(tuple, back.collect())) == sorted(
        map(tuple, df.collect()))

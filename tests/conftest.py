"""Shared Spark session for the tests (local, small shuffle)."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from runledger.session import build_session, checkpoint_root
    session = build_session("local[4]", app_name="runledger-tests",
                            shuffle_partitions=4)
    # The session's spark.checkpoint.dir is used as configured; only when
    # it is unset does checkpoint_root create a local one (local master).
    checkpoint_root(session)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def tmp_dir(spark):
    """A fresh folder below the shared checkpoint root."""
    from runledger.session import new_run_dir
    path = new_run_dir(spark, "test").removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    return path


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

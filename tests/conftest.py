import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    s = build_session("local[4]", app="quarry-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def executed_plan(df) -> str:
    """The physical plan text from the public ``explain`` (runs the query
    first so the adaptive plan is final)."""
    import contextlib
    import io

    df.collect()  # small test inputs: run the query itself so its plan is final
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cardwatch.config import local_session
    session = local_session(shuffle_partitions=8)
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR


def explain_text(df, mode="extended") -> str:
    """What ``df.explain(mode)`` prints (parsed, analyzed, optimized, physical)."""
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lapdeck.session import build_session
    s = build_session("local[4]", app_name="lapdeck-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, cols=None):
    """Collected rows as plain tuples (small test frames only)."""
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]

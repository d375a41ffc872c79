import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from panelwright.session import drop_scratch, get_session

    s = get_session(app="panelwright-tests", master="local[4]", shuffle_partitions=4)
    yield s
    drop_scratch(s)
    s.stop()


def rows(df, order=None):
    """Collected rows as dicts, sorted by ``order`` (or by repr) for stable comparisons."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        return sorted(out, key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return sorted(out, key=repr)

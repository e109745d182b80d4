import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from recaudo.session import get_session
    ckpt = tempfile.mkdtemp(prefix="recaudo-test-ckpt-")
    s = get_session("local[4]", app_name="recaudo-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.sql.ansi.enabled": "true"})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)

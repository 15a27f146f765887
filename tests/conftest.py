import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cladegrid.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 2, "4g")
    # Tiny tables: compiling whole stages would take most of the time.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def rows(df, *columns):
    """Rows as a set of tuples of the given (or all) columns."""
    chosen = columns or df.columns
    return {tuple(r[c] for c in chosen) for r in df.collect()}


def by(df, *keys):
    """Rows as dicts by key."""
    found = {}
    for r in df.collect():
        key = r[keys[0]] if len(keys) == 1 else tuple(r[k] for k in keys)
        found[key] = r.asDict()
    return found

from __future__ import annotations

import math
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from emporia.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, app="emporia-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("EMPORIA_TEST_SF_DIR", SMOKE_DIR)


@pytest.fixture(scope="session")
def duck(sf_dir):
    from emporia.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def canonical(pdf):
    """Columns sorted by name, rows as sorted tuples of normalised values."""
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    rows = sorted((tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)), key=repr)
    return cols, rows

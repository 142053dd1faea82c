"""Every registered query against its DuckDB oracle (the driver's check, at
the smoke scale), and the rows-only queries for a stable schema."""

from __future__ import annotations

import pytest

import __spark_entry__ as se
from conftest import canonical
from emporia.plans import catalog

catalog.load_all()
QUERIES = {k: v for k, v in se.queries().items() if k in catalog.QUERIES}
ORACLES = catalog.ORACLES


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    from tools.typeclass import compare

    q = QUERIES[name](spark, sf_dir)
    assert compare(q.schema, duck.sql(ORACLES[name])) == []
    got = q.toPandas()
    want = duck.execute(ORACLES[name]).df()
    gc, gr = canonical(got)
    wc, wr = canonical(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["dt", "trademark_name", "amount"]
    assert df.count() > 0

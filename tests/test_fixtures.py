"""Derived source tables at keys far beyond those of the given data."""

from __future__ import annotations

import datetime

import duckdb
import pytest
from conftest import canonical

from emporia.plans.fixture_sql import with_ctes
from emporia.sources.fixtures import Fixtures

LINEITEM = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


@pytest.mark.parametrize("key", [300_000_000, 1_000_000_000_000, 10**17])
def test_line_ids_and_times_hold_for_large_keys(spark, tmp_path, key):
    day = datetime.datetime(2024, 1, 1)
    lines = [(k, p, 1, n, 1.0, 10.5 * n, 0.0, 0.0, "N", "O", day) for k in (key, key + 1) for n, p in enumerate((3, 1, 2), 1)]
    spark.createDataFrame(lines, LINEITEM).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(k, k, "O", 40.0, day) for k in (key, key + 1)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(k, 3) for k in (key, key + 1)], "c_custkey long, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(p, f"part {p}") for p in (1, 2, 3)], "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    fx = Fixtures(spark, str(tmp_path), store=False)
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "part"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for name in ("order_detail", "order_info", "user_info"):
        got, text = getattr(fx, name), {"user_info": "birthday"}.get(name, "create_time")
        got = got.select(*[got[c].cast({"decimal": "double"}.get(t[:7], "string" if c == text else t)).alias(c) for c, t in got.dtypes])
        want = con.execute(with_ctes(f"select * replace (cast({text} as varchar) as {text}) from {name}", name)).df()
        assert canonical(got.toPandas())[1] == canonical(want)[1]
    ids = [r.id for r in fx.order_detail.select("id").collect()]
    assert len(set(ids)) == 6 and min(ids) > key

"""Amount split (operator 44) against its specification by prefix sums."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from itertools import accumulate

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.split import amount_split

SCHEMA = T.StructType([
    T.StructField("order_detail_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("sku_price", T.DecimalType(12, 2)),
    T.StructField("sku_num", T.LongType()),
    T.StructField("original_total_amount", T.DecimalType(12, 2)),
    T.StructField("final_total_amount", T.DecimalType(12, 2)),
    T.StructField("final_detail_amount", T.DecimalType(12, 2)),
])


def _d(x) -> Decimal:
    return Decimal(x).quantize(Decimal("0.01"))


def run_split(spark, orders):
    """orders: {order_id: (T, F, [o1, o2, ...])} -> {detail_id: share}"""
    rows = []
    for oid, (t, f, lines) in orders.items():
        for i, o in enumerate(lines):
            rows.append((oid * 1000 + i, oid, _d(o), 1, _d(t), _d(f), None))
    df = spark.createDataFrame(rows, SCHEMA)
    out = amount_split(df).select("order_detail_id", "final_detail_amount").collect()
    return {r[0]: r[1] for r in out}


def specified(lines):
    """Shares of one order's lines (id, gross, T, F): the rounded part of F, or,
    where the prefix sum of a later line meets T, what F has left.  With T = 0
    the first line takes F, later zero lines nothing, and others have no share."""
    sums, given_, out = list(accumulate(o for _, o, _, _ in lines)), Decimal(0), {}
    for k, (did, o, t, f) in enumerate(lines):
        if k and t == 0:
            out[did] = Decimal("0.00") if o == 0 else None
            continue
        meets = sums[k] == t if k else t == 0
        share = f - given_ if meets else (f * o / t).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        out[did], given_ = share, given_ + share
    return out


def reference(orders):
    want = {}
    for oid, (t, f, lines) in orders.items():
        seq = [(oid * 1000 + i, _d(o), _d(t), _d(f)) for i, o in enumerate(lines)]
        try:
            want.update(specified(seq))
        except ArithmeticError:  # the reference divides by zero: no share
            want.update({did: None for did, *_ in seq})
    return want


HAND = {
    1: ("100.00", "90.00", ["100.00"]),                     # single line
    2: ("60.00", "50.00", ["10.00", "20.00", "30.00"]),     # remainder on the last line
    3: ("30.00", "29.99", ["10.00", "20.00", "0.00"]),      # zero-gross line after the completing one
    4: ("0.00", "5.00", ["0.00", "0.00"]),                  # gross total 0: first line takes F
    5: ("30.00", "27.00", ["10.00", "20.00", "30.00"]),     # completes at line 2, line 3 beyond T
    6: ("30.00", "27.00", ["10.00", "25.00"]),              # never completes
    7: ("3.00", "1.00", ["1.00", "1.00", "1.00"]),          # thirds: rounding goes to the remainder
    9: ("30.00", "10.00", ["10.00", "10.00", "10.00", "-5.00", "5.00"]),  # meets T, then a negative line
    8: ("10.00", "10.00", ["0.00", "10.00"]),               # first line zero, second completes
}


def test_hand_cases(spark):
    got = run_split(spark, HAND)
    want = reference(HAND)
    assert got == want
    assert got[2002] == Decimal("25.00")
    assert got[7002] == Decimal("0.34")
    assert got[4000] == Decimal("5.00") and got[4001] == Decimal("0.00")


def test_shares_add_up_to_paid_total_when_lines_add_up(spark):
    got = run_split(spark, {k: v for k, v in HAND.items() if k in (1, 2, 3, 7, 8)})
    for oid in (1, 2, 3, 7, 8):
        t, f, lines = HAND[oid]
        assert sum(got[oid * 1000 + i] for i in range(len(lines))) == _d(f)


cents = st.integers(min_value=0, max_value=50_000)


@st.composite
def orders_strategy(draw):
    n = draw(st.integers(min_value=1, max_value=12))
    out = {}
    for oid in range(1, n + 1):
        lines = draw(st.lists(cents, min_size=1, max_size=6))
        consistent = draw(st.booleans())
        t = sum(lines) if consistent else draw(cents)
        f = draw(st.integers(min_value=0, max_value=80_000))
        out[oid] = (Decimal(t) / 100, Decimal(f) / 100, [Decimal(o) / 100 for o in lines])
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(orders_strategy())
def test_property_matches_reference_loop(spark, orders):
    assert run_split(spark, orders) == reference(orders)


# ---- streaming split: per-order function, no Spark ---------------

@st.composite
def stream_orders(draw):
    orders = draw(orders_strategy())
    cuts = {oid: draw(st.lists(st.booleans(), min_size=len(v[2]), max_size=len(v[2]))) for oid, v in orders.items()}
    return orders, cuts


@settings(max_examples=60, deadline=None)
@given(stream_orders())
def test_stream_split_lines_matches_reference_loop_across_batches(data):
    from pyspark.sql import Row

    from emporia.streaming.split_state import split_lines

    orders, cuts = data
    # lines in detail-id order; a True cut starts a new micro-batch after that line
    batches, cur = [], []
    for oid, (t, f, lines) in orders.items():
        for i, o in enumerate(lines):
            raw = (f * o / t).quantize(Decimal("0.01"), ROUND_HALF_UP) if t else Decimal(0)
            cur.append(Row(order_id=oid, order_detail_id=oid * 1000 + i, known=True, o_c=int(o * 100), t_c=int(t * 100),
                            f_c=int(f * 100), raw_c=int(raw * 100) if t or not o else None))
            if cuts[oid][i]:
                batches.append(cur)
                cur = []
    if cur:
        batches.append(cur)
    state, got = {}, {}
    for b in batches:
        longs = lambda c: np.array([getattr(r, c) or 0 for r in b], np.int64)
        by, shares, new = split_lines(longs("order_id"), longs("order_detail_id"), np.array([r.known for r in b]), longs("o_c"), longs("t_c"),
                                      longs("f_c"), longs("raw_c"), np.array([r.raw_c is not None for r in b]), state)
        state |= new
        got |= {b[i].order_detail_id: None if c is None else Decimal(c) / 100 for i, c in zip(by, shares)}
    want = reference(orders)
    # the reference raises on a division by zero; compare the orders it can split
    assert {k: v for k, v in got.items() if want.get(k) is not None} == {k: v for k, v in want.items() if v is not None}


def test_narrow_stats_equal_stats_from_wide_rows(spark, sf_dir):
    from pyspark.sql import functions as F

    from emporia.operators.split import MONEY, _raw_share, narrow_stats, order_stats
    from emporia.plans.warehouse import Warehouse

    w = Warehouse.of(spark, sf_dir)
    wide = w.wide_unsplit
    T, Fp = F.col("original_total_amount"), F.col("final_total_amount")
    lines = wide.select(
        "order_id", "order_detail_id", (F.col("sku_price") * F.col("sku_num")).cast(MONEY).alias("_o"),
        T, Fp,
    ).withColumn("_raw", F.when(T != 0, _raw_share(Fp, F.col("_o"), T)))
    a = order_stats(lines)
    b = narrow_stats(w.fx.order_detail, w.fx.order_info)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _wide_of(spark, n, total, lines="id"):
    """One order of ``n`` lines of gross 1.00, 2.00 and -1.00 in turn, and a gross total of ``total``."""
    return spark.range(n).select(
        (F.col("id") + 10).alias("order_detail_id"), F.lit(5).cast("long").alias("order_id"),
        F.element_at(F.array(*[F.lit(x).cast("decimal(12,2)") for x in (1, 2, -1)]), (F.col("id") % 3 + 1).cast("int")).alias("sku_price"),
        F.lit(1).cast("long").alias("sku_num"), F.lit(total).cast("decimal(12,2)").alias("original_total_amount"),
        F.lit(777.77).cast("decimal(12,2)").alias("final_total_amount"), F.lit(None).cast("decimal(12,2)").alias("final_detail_amount"),
    )


def test_ranges_of_an_order_give_the_rule_line_by_line(spark):
    for total in (40, 41, 1_000_000):
        got = {r[0]: r[1] for r in amount_split(_wide_of(spark, 200, total), range_lines=7).select("order_detail_id", "final_detail_amount").collect()}
        acc, paid, want = Decimal(0), Decimal(0), {}
        for i in range(200):
            o = Decimal((1, 2, -1)[i % 3])
            acc += o
            raw = (Decimal("777.77") * o / total).quantize(Decimal("0.01"), ROUND_HALF_UP)
            want[i + 10] = Decimal("777.77") - paid if i and acc == total else raw
            paid += want[i + 10]
        assert got == want


def test_an_open_order_of_a_million_lines_spreads_over_tasks(spark):
    lines = 1_000_000
    out = amount_split(_wide_of(spark, lines, 10_000_000), range_lines=50_000)
    with_ranges = out.agg(F.sum("final_detail_amount"), F.count("*")).first()
    whole = amount_split(_wide_of(spark, lines, 10_000_000), range_lines=lines).agg(F.sum("final_detail_amount"), F.count("*")).first()
    assert with_ranges == whole and whole[1] == lines
    plan = out._jdf.queryExecution().executedPlan().toString()
    # every window over an order's lines is split by range; the ones left see one row a range or completing line
    windows = [w for w in plan.splitlines() if "Window [sum(" in w and "order_detail_id" in w]
    assert windows and all("_range" in w for w in windows)

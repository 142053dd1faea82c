"""The layered warehouse as lazily built DataFrames over one testdata folder.

ODS fixtures -> DIM (user labels, sku names) -> DWD (enriched orders and
lines) -> DWS (wide rows with paid shares) -> marts.  Nothing here runs until
a query asks for a result; Catalyst sees each query's whole plan and prunes
every column and join it does not need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from emporia.functions.labels import DEFAULT_AS_OF
from emporia.operators import dims, orders, split
from emporia.session import app_id
from emporia.sources.fixtures import Fixtures


_SESSION_WAREHOUSES: dict[tuple[str, str, str], "Warehouse"] = {}


class Warehouse:
    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> "Warehouse":
        """The session's warehouse over ``sf_dir``.  DataFrames are immutable
        plans, so queries share one set of layer frames (built and analysed
        once per application) instead of re-building them per query."""
        key = (app_id(spark), sf_dir, as_of)
        w = _SESSION_WAREHOUSES.get(key)
        if w is None:
            w = _SESSION_WAREHOUSES[key] = cls(spark, sf_dir, as_of)
        return w

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.fx = Fixtures(spark, sf_dir)

    # DIM
    @cached_property
    def users(self) -> DataFrame:
        return dims.user_dim(self.fx.user_info, self.as_of)

    @cached_property
    def skus(self) -> DataFrame:
        return dims.sku_dim(self.fx.sku, self.fx.category3, self.fx.trademark, self.fx.spu)

    # DWD
    @cached_property
    def order_info(self) -> DataFrame:
        return orders.dwd_order_info(self.fx.order_info, self.fx.province, self.users)

    @cached_property
    def order_detail(self) -> DataFrame:
        return orders.dwd_order_detail(self.fx.order_detail, self.skus)

    # DWS
    @cached_property
    def wide_unsplit(self) -> DataFrame:
        return orders.join_order_detail(self.order_info, self.order_detail)

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order ⋈ line without any dimension."""
        return orders.order_lines(self.fx.order_info, self.fx.order_detail)

    @cached_property
    def paid_lines(self) -> DataFrame:
        """``order_lines`` with their paid shares: the split works on narrow
        rows, and whoever needs a dimension joins it to the result, once."""
        stats = split.narrow_stats(self.fx.order_detail, self.fx.order_info)
        return split.amount_split(self.order_lines, stats=stats)

    @cached_property
    def paid_trademarks(self) -> DataFrame:
        return dims.join_trademark(self.paid_lines, self.fx.sku, self.fx.trademark)

    @cached_property
    def wide(self) -> DataFrame:
        """Wide rows with ``final_detail_amount`` (money still decimal).

        The rows of users and skus are joined to the narrow orders and lines
        and cross the split in arrays: joined after it, where they are many,
        each shuffles all wide rows once more."""
        o, d = orders.with_user_rows(self.fx.order_info, self.users), orders.with_sku_rows(self.fx.order_detail, self.skus)
        lines = orders.order_lines(o, d, (orders.USER_ATTRIBUTES, orders.SKU_ATTRIBUTES))
        stats = split.narrow_stats(self.fx.order_detail, self.fx.order_info)
        return orders.unfolded(split.amount_split(lines, stats=stats), self.fx.province)

    def widened(self, lines: DataFrame) -> DataFrame:
        """The wide row of order lines: province, user and sku attributes."""
        return orders.widened(lines, self.fx.province, self.users, self.skus)

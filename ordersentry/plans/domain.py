"""The model graph over one data directory.

``Domain`` builds each relation once (lazily) and hands out DataFrames:

    raw products / users (mapped from part / customer)
    order events (mapped from events, priced)  -> screening -> raw_orders
    -> staging -> dimensions -> fact -> marts
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import fraud
from ..sources import tpch_domain as src
from . import warehouse as wh


@dataclass
class Domain:
    spark: SparkSession
    sf_dir: str
    variant: str = "base"
    params: fraud.FraudParams = field(default_factory=fraud.FraudParams)
    lenient: bool = False      # malformed ids are left out of the fact instead of failing it

    @cached_property
    def raw_products(self) -> DataFrame:
        return src.raw_products(self.spark, self.sf_dir)

    @cached_property
    def raw_users(self) -> DataFrame:
        return src.raw_users(self.spark, self.sf_dir)

    @cached_property
    def order_events(self) -> DataFrame:
        return src.order_events(self.spark, self.sf_dir, self.variant, products=self.raw_products)

    def screened(self, keep_flags: bool = False, attribution: bool = True) -> DataFrame:
        return fraud.screen(self.order_events, params=self.params, keep_flags=keep_flags, attribution=attribution)

    @cached_property
    def raw_orders(self) -> DataFrame:
        return src.raw_orders(self.screened(attribution=False))

    @cached_property
    def stg_users(self) -> DataFrame:
        return wh.stg_users(self.raw_users)

    @cached_property
    def stg_products(self) -> DataFrame:
        return wh.stg_products(self.raw_products)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return wh.stg_orders(self.raw_orders)

    @cached_property
    def dim_users(self) -> DataFrame:
        return wh.dim_users(self.stg_users)

    @cached_property
    def dim_products(self) -> DataFrame:
        return wh.dim_products(self.stg_products)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return wh.fct_orders(self.stg_orders, self.dim_users, self.dim_products, self.lenient)

    def mart(self, name: str, fct: DataFrame | None = None) -> DataFrame:
        return wh.MARTS[name](fct if fct is not None else self.fct_orders,
                              self.dim_users, self.dim_products)

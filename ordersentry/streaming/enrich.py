"""Price lookup for a stream of orders.

The original producer keeps a product price cache and refreshes it when it
is older than an hour.  On Spark the lookup is a stream-static join done
per micro-batch: the product table is re-read (re-listed) at most once per
``refresh_seconds``, so new products and price changes are picked up
without restarting the query.  The join itself is the batch
:func:`ordersentry.sources.tpch_domain.enrich_amount` (broadcast only when
the product side is measured small, sort-merge otherwise).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strip_prefix_id
from ..sources.tpch_domain import enrich_amount


class PriceLookup:
    """Callable ``(micro_batch) -> priced micro_batch``; orders carry
    ``product_id`` as ``P<n>``, the product table ``product_id`` / ``price``."""

    def __init__(self, spark: SparkSession, products_path: str, refresh_seconds: float = 3600.0):
        self.spark, self.path, self.refresh = spark, products_path, refresh_seconds
        self._prices: DataFrame | None = None
        self._loaded_at = 0.0

    def prices(self) -> DataFrame:
        if self._prices is None or time.monotonic() - self._loaded_at >= self.refresh:
            self._prices = (self.spark.read.parquet(self.path)
                            .select(F.col("product_id").alias("_pnum"), "price"))
            self._loaded_at = time.monotonic()
        return self._prices

    def __call__(self, orders: DataFrame) -> DataFrame:
        keyed = orders.withColumn("_pnum", strip_prefix_id("product_id", "P", lenient=True))
        return enrich_amount(keyed.drop("amount", "amount_numeric"), self.prices(), key="_pnum").drop("_pnum")


def priced_batches(lookup: PriceLookup, sink: Callable[[DataFrame, int], None]):
    """``foreachBatch`` function: price each micro-batch, hand it to ``sink``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(lookup(batch), batch_id)
    return run

import datetime as dt

from pyspark.sql import functions as F

from ordersentry.plans.models import LAYOUTS
from ordersentry.sources import layout
from ordersentry.sources.tables import materialize

FACT = LAYOUTS["fct_orders"].cluster_by


def fact(spark, n=40_000):
    return spark.range(n).select(
        F.col("id").alias("order_id"), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(5000)).alias("user_id"),
        F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(300)).alias("product_id"),
        F.when(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(50)) == 0, "SG").otherwise("ID").alias("country"),
        F.when(F.pmod(F.xxhash64(F.lit(4), "id"), F.lit(20)) == 0, "Fraud").otherwise("Genuine").alias("fraud_status"))


def test_every_cluster_column_skips_files(spark, tmp_path):
    path, rows = str(tmp_path / "t"), fact(spark)
    layout.clustered(rows, [], FACT, files=64).write.parquet(path)
    layout.write_manifest(spark, path, FACT)
    every = spark.read.parquet(f"{path}_files").count()
    assert every >= 60
    for where, share in (({"user_id": (100, 110)}, 0.35), ({"product_id": (7, 7)}, 0.35), ({"country": ("SG", "SG")}, 0.2),
                         ({"fraud_status": ("Fraud", "Fraud")}, 0.25), ({"user_id": (None, 50), "fraud_status": ("Fraud", None)}, 1.0)):
        opened = layout.files_where(spark, path, where).count()
        assert opened <= share * every, (where, opened, every)
        want = rows
        for c, (lo, hi) in where.items():
            want = want.filter((F.col(c) >= lo if lo is not None else F.lit(True)) & (F.col(c) <= hi if hi is not None else F.lit(True)))
        got = layout.read_where(spark, path, where)
        assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0
    # A sort by the columns in turn skips next to nothing on the last one.
    plain = str(tmp_path / "plain")
    rows.repartitionByRange(64, *FACT).write.parquet(plain)
    layout.write_manifest(spark, plain, FACT)
    assert layout.files_where(spark, plain, {"fraud_status": ("Fraud", "Fraud")}).count() > 0.9 * every
    assert layout.read_where(spark, path, {"user_id": (10 ** 9, None)}).count() == 0


def test_the_input_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = fact(spark, 3000)
    table = materialize(rows.mapInArrow(read, rows.schema), "t", path=str(tmp_path / "t"), cluster_by=FACT)
    assert seen.value == 3000 == table.count()


def test_ranks_of_odd_columns(spark, tmp_path):
    rows = [(None, None, float("nan"), dt.datetime(2024, 1, 1), True), (1, "é", 1.5, None, False), (2 ** 60, "", None, dt.datetime(2024, 1, 2), None),
            (-5, "z" * 100, -0.0, dt.datetime(1960, 1, 1), True)]
    df = spark.createDataFrame(rows * 30, "a long, b string, c double, d timestamp, e boolean")
    for columns in (["a", "b", "c"], ["d", "e"], ["a"]):
        path = str(tmp_path / "-".join(columns))
        table = materialize(df, "t", path=path, cluster_by=columns)
        assert table.count() == 120
    empty = materialize(df.limit(0), "t", path=str(tmp_path / "none"), cluster_by=["a", "b"])
    assert empty.count() == 0


def test_few_and_skewed_values_spread_over_the_ranks(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 100 == 0, "SG").otherwise("ID").alias("c"), F.pow(F.lit(1.01), F.col("id") % 2000).alias("x"))
    bounds = layout.rank_bounds(df, ["c", "x"])
    assert bounds["c"] == ["SG"] and len(bounds["x"]) == 255
    ranks = df.select(layout._rank(F.col("c"), bounds["c"]).alias("c"), layout._rank(F.col("x"), bounds["x"]).alias("x"))
    assert {r[0] for r in ranks.select("c").distinct().collect()} == {0, 255}
    sizes = [r["count"] for r in ranks.groupBy("x").count().collect()]
    assert len(sizes) > 200 and max(sizes) < 60

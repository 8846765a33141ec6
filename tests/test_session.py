"""Settling tables."""

from pyspark.sql import functions as F

from cohortica.session import CONSTRAINTS, LEAN, settle


def test_a_wide_table_settles(spark):
    df = spark.range(50).withColumns({f"c{k}": F.when(F.col("id") % (k + 7) != 3, F.col("id") + k) for k in range(100)})
    for _ in range(3):
        df = df.withColumns({f"c{k}": F.col(f"c{k}") * F.col(f"c{(k + 1) % 100}") + F.col("id") for k in range(100)})
    before = spark.conf.get(CONSTRAINTS, "true")
    rows = settle(df.na.drop())
    assert rows.count() == df.na.drop().count()
    assert spark.conf.get(CONSTRAINTS, "true") == before


def test_a_settled_filter_keeps_the_conditions_derived_for_its_join(spark):
    a = spark.range(10).select(F.when(F.col("id") > 4, F.col("id")).alias("k"))
    b = spark.range(10).select(F.col("id").alias("k"))
    assert sorted(r.k for r in settle(a.join(b, "k")).collect()) == [5, 6, 7, 8, 9]


def test_a_lean_table_is_whole_and_gives_the_settings_back(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "777")
    before = {key: spark.conf.get(key, None) for key in LEAN}
    counts = settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), lean=True)
    assert sorted(r["count"] for r in counts.collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert {key: spark.conf.get(key, None) for key in LEAN} == before
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

"""The job of the relu net reads its table once."""

from pyspark.sql import functions as F

from broadloom.plans import jobs


def test_prepared_rows_are_stored_once_and_stay_the_same(spark):
    i = F.col("id")
    table = spark.range(0, 600, 1, 3).select(
        "id", (i % 2).cast("int").alias("label"), F.when(i % 3 == 0, "a").otherwise("b").alias("kind"), F.when(i % 11 != 0, F.sin(i)).alias("v"))
    plain, stored = (jobs.prepared(table, "label", ["kind"], ["v"], ["id"], stored=s) for s in (False, True))
    for a, b in zip(plain, stored):
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert "Exchange" in a._jdf.queryExecution().toString() and "Exchange" not in b._jdf.queryExecution().toString()

"""P-6 over a dimension with more locations than the test tables have."""

from pyspark.sql import functions as F

from checks import queries


def test_every_location_of_the_dimension_has_a_column(spark, monkeypatch):
    trend = spark.createDataFrame(
        [(1, "nation_0", 5), (1, "new place", 6), (2, None, 7)], "month int, location_name string, total_attendance bigint"
    )
    places = spark.createDataFrame([("Nation_0",), ("New Place",), ("Unused",), (None,)], "location_name string")
    monkeypatch.setattr(queries, "domain_tables", lambda spark, sf_dir: {"dim_location": places})
    monkeypatch.setattr(queries.classes, "location_trend", lambda tables, year: trend)
    monkeypatch.setattr(queries, "location_trend", lambda spark, sf_dir: trend)
    found = queries.queries()["p06_pivot"](spark, "")
    assert sorted(found.columns) == ["month", "nation_0", "new place", "null", "unused"]
    kept = found.select("month", sum(F.col(f"`{c}`") for c in found.columns if c != "month").alias("n")).collect()
    assert sorted(map(tuple, kept)) == [(1, 11), (2, 7)]

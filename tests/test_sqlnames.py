"""SQL functions equal their column forms; views show what the files hold now."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareflow.functions import columns as C
from fareflow.functions import sqlnames as S
from fareflow.operators.layout import plan_text


def test_functions_equal_the_column_helpers(spark):
    S.create_functions(spark)
    at = [dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2023, 12, 31), None, dt.datetime(1969, 12, 31, 23)]
    codes = ["B02884", "B02877", "B00021", "Bx", "", None, "B99999999", "B0", "B-5"]
    rows = [(i % 9 if i < 9 else None, codes[i % 9], at[i % 4], at[(i + 1) % 4]) for i in range(12)]
    d = spark.createDataFrame(rows, "n int, code string, a timestamp_ntz, b timestamp_ntz")
    d.createOrReplaceTempView("sqlnames_rows")
    got = spark.sql("SELECT payment_description(n), vendor_name(n), month_start(a), minutes_between(a, b), "
                    "base_id(code) FROM sqlnames_rows").collect()
    want = d.select(C.payment_description("n"), C.vendor_name("n"), C.month_start("a"),
                    C.minutes_between("a", "b"), C.base_id("code")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_functions_are_expanded_and_filters_reach_the_scan(spark, tmp):
    S.create_functions(spark)
    spark.range(100).select(F.col("id").cast("int").alias("n"), F.lit("x").alias("s")).write.parquet(f"{tmp}/t")
    S.create_view(spark, "sqlnames_t", f"{tmp}/t")
    plan = plan_text(spark.sql("SELECT vendor_name(n) AS v FROM sqlnames_t WHERE n > 90"))
    assert "PushedFilters: [IsNotNull(n), GreaterThan(n,90)]" in plan and "ReadSchema: struct<n:int>" in plan
    assert "CASE" in plan and "Python" not in plan


@pytest.mark.parametrize("temporary", [True, False])
def test_a_changed_source_shows_through(spark, tmp, temporary):
    S.create_functions(spark, None if temporary else "default", temporary)
    spark.range(3).write.parquet(f"{tmp}/t")
    name = S.create_view(spark, f"sqlnames_{'temp' if temporary else 'kept'}", f"{tmp}/t",
                         ("" if temporary else "default.") + "vendor_name(CAST(id AS INT)) AS v, id", "id > 0",
                         temporary)
    assert spark.sql(f"SELECT * FROM {name}").count() == 2
    spark.range(3, 7).write.mode("append").parquet(f"{tmp}/t")
    assert {r.id: r.v for r in spark.sql(f"SELECT * FROM {name}").collect()}[4] == "Unknown Vendor"
    assert spark.sql(f"SELECT * FROM {name}").count() == 6


def test_names_are_checked(spark):
    for bad in ("a b", "x;", "`x`", "a.b.c", ""):
        with pytest.raises(ValueError):
            S.create_view(spark, bad, "/tmp/x")
    with pytest.raises(ValueError):
        S.create_view(spark, "v", "/tmp/`x")
    with pytest.raises(ValueError):
        S.create_functions(spark, "default", temporary=True)

"""VARIANT bronze and silver over records that are malformed or change type."""

import pytest
from pyspark.sql import functions as F

from fareflow.operators import variants as V
from fareflow.session import staged

TEXTS = ['{"k": 1, "at": {"zone": "a"}}', '{"k": "2"}', '{"k": "many"}', '{"k": [1]}', '{"k": null}', "{}",
         '{"k": 3', "", None, "null", '"text"', '{"k": 1, "k": 2}', '{"k": 2.5, "at": {"zone": 7}}', "[1, 2]"]
FIELDS = {"k": ("$.k", "bigint"), "zone": ("$.at.zone", "string")}


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id int, raw string")


def test_no_record_is_lost(spark):
    good, dead = V.bronze(frame(spark), "raw")
    good = staged(good, "variants")  # VARIANT columns survive Parquet
    assert sorted(r.raw for r in dead.collect()) == sorted(["", '{"k": 3', '{"k": 1, "k": 2}'])
    assert good.count() + dead.count() == len(TEXTS)
    got = {r.id: (r.k, r.zone, r.unfit) for r in V.silver(good, FIELDS).collect()}
    assert got[0] == (1, "a", []) and got[1] == (2, None, [])
    assert got[2] == (None, None, ["k"]) and got[3] == (None, None, ["k"])
    for i in (4, 5, 8, 9, 10, 13):
        assert got[i] == (None, None, []), i
    assert got[12][1:] == ("7", []) and got[12][0] == 2


def test_shapes_show_a_type_change(spark):
    good, _ = V.bronze(frame(spark), "raw")
    n = {r.shape: r.n for r in V.shapes(good, "$.k").collect()}
    assert n["STRING"] == 2 and n["BIGINT"] == 1 and sum(n.values()) == 11
    one = V.bronze(frame(spark, ['{"a": 1}', '{"b": "x", "a": 2}']), "raw")[0]
    assert V.merged_schema(one).first().schema == "OBJECT<a: BIGINT, b: STRING>"


def test_empty_tables_and_clashing_names(spark):
    good, dead = V.bronze(frame(spark).limit(0), "raw")
    assert dead.count() == 0 and V.silver(good, FIELDS).columns == ["id", "k", "zone", "unfit"]
    assert V.silver(good, {}).count() == 0
    with pytest.raises(ValueError):
        V.bronze(frame(spark).withColumn("record", F.lit(1)), "raw")
    with pytest.raises(ValueError):
        V.silver(good, {"id": ("$.k", "int")})

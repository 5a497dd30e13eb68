"""What the registered queries render for the operators is worked out once per row."""

import os

import pytest
from pyspark.sql import functions as F

from checks import REGISTRY
from checks.flatten import json_text, with_raw

SMOKE = "/root/testdata/sf0.001"


def test_raw_fields_render_their_object_once(spark):
    rows = spark.createDataFrame([(1, '[{"b":"}"}]', None), (2, None, "3")], "n INT, list STRING, number STRING")
    text = with_raw(json_text(n=F.col("n"), t=F.lit("x}")), list=F.col("list"), number=F.col("number"))
    made = rows.select(text.alias("value"))
    read = made.select(F.from_json("value", "n INT, t STRING, list STRING, number INT").alias("r")).select("r.*")
    assert [tuple(r) for r in read.collect()] == [(1, "x}", '[{"b":"}"}]', None), (2, "x}", None, 3)]
    plan = made._jdf.queryExecution().analyzed().toString()
    assert plan.count("to_json") == 1 and plan.count("list#") <= 3


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="no test tables")
@pytest.mark.parametrize("key", ["export_projection", "flatten_output_schema"])
def test_answers_are_not_built_for_a_filter(spark, key):
    plan = REGISTRY[key].run(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "transform" in line]

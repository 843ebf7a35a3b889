"""Exact sums of doubles, against correctly rounded ones."""

import math
import random

import pytest
from pyspark.sql import functions as F

from salesmart.operators.exact import exact_sum_by, merged_state, sum_state, with_rounded

HARD = [
    [0.1] * 10, [1e28, 1.0, -1e28], [2.0**93, 2.0**-41, -(2.0**93)], [2.0**-42], [-(2.0**-42)] * 3, [-0.0], [0.0, -5.5],
    [2.0**53, 1.0, 2.0**-40], [2.0**53, 1.0], [2.0**53 + 2, 1.0], [2.0**53, 1.0, -(2.0**-40)], [-(2.0**53), -1.0, -(2.0**-40)], [2.0**93 + 2.0**41, 1.0],
    [1.5, -1.5], [2.0**32] * 7, [2.0**-31, -(2.0**-32)], [-(2.0**-31)], [-(2.0**32), 2.0**-31], [2.0**62, 2.0**62, -1.0], [9007199254740993.0, 0.5, 2.0**-41],
]


def groups():
    draw = random.Random(7)
    out = list(HARD)
    for _ in range(400):
        scale = draw.choice([1, 1e-9, 1e6, 1e20])
        out.append([draw.choice([-1, 1]) * round(draw.random() * 10**draw.randint(0, 6), 2) * scale for _ in range(draw.randint(1, 60))])
    for values in out[-100:]:
        values += [-v for v in values[: len(values) // 2]] + [draw.uniform(-1, 1) * 2.0 ** draw.randint(-40, 90) for _ in range(5)]
    return [[v for v in values if v == 0 or abs(v) >= 2.0**-42] for values in out]


def test_sums_are_correctly_rounded_however_rows_lie(spark):
    found = groups()
    rows = [(g, v) for g, values in enumerate(found) for v in values]
    expected = {g: math.fsum(values) for g, values in enumerate(found) if values}
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double")
    for partitions in (1, 7):
        sums = exact_sum_by(df.repartition(partitions), ["k"], "v", "total").collect()
        assert {r["k"]: r["total"] for r in sums} == expected


def test_states_merge(spark):
    found = groups()
    df = spark.createDataFrame([(g, i % 3, v) for g, values in enumerate(found) for i, v in enumerate(values)], "k int, part int, v double")
    states = df.groupBy("k", "part").agg(sum_state(F.col("v")).alias("s"))
    merged = with_rounded(states.groupBy("k").agg(merged_state("s").alias("s")), "s", "total")
    assert {r["k"]: r["total"] for r in merged.collect()} == {g: math.fsum(v) for g, v in enumerate(found) if v}


@pytest.mark.parametrize(
    ("values", "total"),
    [
        ([None, None], None), ([None, 2.5], 2.5), ([float("inf"), 1.0], float("inf")), ([float("-inf"), 1.0], float("-inf")),
        ([1e300, 1.0], 1e300), ([1e-300], 1e-300), ([5.0, 1e-20], 5.0),
    ],
)
def test_values_out_of_the_ordinary(spark, values, total):
    df = spark.createDataFrame([(None, v) for v in values], "k int, v double")
    assert [tuple(r) for r in exact_sum_by(df, ["k"], "v", "total").collect()] == [(None, total)]


def test_not_a_number_and_other_types(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 2.0)], "k int, v double")
    assert math.isnan(exact_sum_by(df, ["k"], "v", "total").first()["total"])
    as_cents = df.where("v = 2").withColumn("v", F.col("v").cast("decimal(10,2)"))
    assert exact_sum_by(as_cents, ["k"], "v", "total").dtypes[1][1] == "decimal(20,2)"
    assert exact_sum_by(df.limit(0), ["k"], "v", "total").count() == 0

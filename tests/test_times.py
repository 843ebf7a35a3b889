import datetime as dt

import pytest

from salesmart.functions.times import at_grain, calendar_parts, epoch_seconds, epoch_timestamp
from pyspark.sql import functions as F


def converted(spark, *nanos):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(nanos)], "i int, n bigint")
    rows = df.select("i", epoch_timestamp("n").cast("string"), epoch_seconds("n")).orderBy("i").collect()
    return [row[1] for row in rows], [row[2] for row in rows]


def test_nanoseconds_lose_their_fraction_toward_zero(spark):
    text, seconds = converted(
        spark, 1_517_961_599_430_000_000, 1_517_961_599_999_999_999, 0, -1_500_000_000, None
    )
    assert text == [
        "2018-02-06 23:59:59", "2018-02-06 23:59:59", "1970-01-01 00:00:00", "1969-12-31 23:59:59", None,
    ]
    assert seconds == [1_517_961_599.43, 1_517_961_600.0, 0.0, -1.5, None]


def test_instant_survives_a_repeated_local_hour(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    df = spark.createDataFrame([(1_509_863_400_000_000_000,)], "n bigint")
    assert df.select(F.unix_seconds(epoch_timestamp("n"))).first()[0] == 1_509_863_400


@pytest.mark.parametrize(
    ("day", "parts"),
    [
        ("2018-12-31 10:00:00", (2018, 12, 1, 31, 2, 4)),
        ("2018-01-07 00:00:00", (2018, 1, 1, 7, 1, 1)),
        (None, (None,) * 6),
    ],
)
def test_calendar_parts(spark, day, parts):
    df = spark.createDataFrame([(day,)], "t string").selectExpr("CAST(t AS timestamp) AS t")
    assert tuple(df.select(*calendar_parts("t")).first()) == parts


def test_grain(spark):
    df = spark.sql("SELECT TIMESTAMP '2018-01-07 13:14:15' AS t")
    row = df.select(at_grain(F.col("t"), "second"), at_grain(F.col("t"), "day")).first()
    assert tuple(row) == (dt.datetime(2018, 1, 7, 13, 14, 15), dt.datetime(2018, 1, 7))
    with pytest.raises(ValueError, match="unknown grain"):
        at_grain(F.col("t"), "week")

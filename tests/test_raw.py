import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from salesmart.sources.raw import RawFiles, read_raw, with_sales_times
from salesmart.sources.schemas import RAW_TABLES, raw_schema


def test_nanosecond_timestamps_are_read_as_bigint(spark, tmp_path):
    times = pa.array([1_517_961_599_430_000_000, None], pa.timestamp("ns"))
    pq.write_table(pa.table({"SalesID": pa.array([1, 2]), "SalesDate": times}), tmp_path / "sales.parquet")
    sales = with_sales_times(RawFiles(spark, str(tmp_path))["sales"]).orderBy("SalesID")
    found = sales.selectExpr("SalesDate", "CAST(SalesTimestamp AS string)").collect()
    assert [tuple(row) for row in found] == [(1_517_961_599_430_000_000, "2018-02-06 23:59:59"), (None, None)]


def test_columns_match_by_name_in_any_case(spark, tmp_path):
    path = str(tmp_path / "cities.parquet")
    spark.sql("SELECT 7 AS extra, 3 AS CITYID, 'Oslo' AS cityname").write.parquet(path)
    cities = read_raw(spark, "cities", path)
    assert cities.schema == raw_schema("cities")
    assert [tuple(row) for row in cities.collect()] == [(3, "Oslo", None, None)]


def test_a_column_of_the_wrong_type_fails(spark, tmp_path):
    path = str(tmp_path / "categories.parquet")
    spark.sql("SELECT 1L AS CategoryID, 2L AS CategoryName").write.parquet(path)
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH|FAILED_READ_FILE"):
        read_raw(spark, "categories", path).collect()


def test_only_requested_tables_are_opened(spark, tmp_path):
    raw = RawFiles(spark, str(tmp_path))
    assert tuple(raw) == RAW_TABLES and len(raw) == 7
    with pytest.raises(FileNotFoundError, match="no data file"):
        raw["sales"]
    with pytest.raises(KeyError):
        raw["stores"]
    with pytest.raises(ValueError, match="unknown raw table"):
        raw_schema("stores")

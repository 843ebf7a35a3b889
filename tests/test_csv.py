import pytest

from salesmart.sources.csv_ingest import CsvOptions, csv_tables, csv_to_parquet
from salesmart.sources.raw import RawFiles, with_sales_times
from salesmart.sources.catalog import register_external
from tests.frames import nanos, values

SALES = """SalesID,SalesPersonID,CustomerID,ProductID,Quantity,Discount,TotalPrice,SalesDate,TransactionNumber
1,6,27039,381,7,0.00,10.5,2018-02-05 07:38:25.430,FQL4S94E4ME1EZFTG42G
2,,NA,,,NULL,nan,,
3,1,2,3,4,-1.5e2,3,2018-02-06T23:59:59.123456789,NULL
4,1,2,3,4,.5,1,2018-02-06,"a ""quoted"", text"
5,1,2,3,4,0,1,2018-02-06 01:00:00+02:00,x
6,1,2,3,4,0,1,1517961599430000000,x
"""


def write(folder, **texts):
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_declared_table(spark, tmp_path):
    folder = write(tmp_path, sales=SALES)
    assert csv_to_parquet(spark, folder) == {"sales": {"rows": 6}}
    sales = RawFiles(spark, folder)["sales"].drop("SalesPersonID", "ProductID", "Quantity")
    assert values(sales) == [
        (1, 27039, 0.0, 10.5, nanos("2018-02-05 07:38:25.430"), "FQL4S94E4ME1EZFTG42G"),
        (2, None, None, None, None, ""),
        (3, 2, -150.0, 3.0, nanos("2018-02-06 23:59:59.123456") + 789, "NULL"),
        (4, 2, 0.5, 1.0, nanos("2018-02-06 00:00:00"), 'a "quoted", text'),
        (5, 2, 0.0, 1.0, nanos("2018-02-05 23:00:00"), "x"),
        (6, 2, 0.0, 1.0, 1_517_961_599_430_000_000, "x"),
    ]


def test_dates_do_not_depend_on_the_session_zone(spark, tmp_path, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    folder = write(tmp_path, sales="SalesID,SalesDate\n1,2017-11-05 01:30:00\n2,2018-03-11 02:30:00\n")
    csv_to_parquet(spark, folder, options=CsvOptions(allow_absent=True))
    sales = RawFiles(spark, folder)["sales"].select("SalesDate")
    assert values(sales) == [(nanos("2017-11-05 01:30:00"),), (nanos("2018-03-11 02:30:00"),)]


def test_other_columns_and_tables_are_kept_with_inferred_types(spark, tmp_path):
    text = (
        "id,flag,day,at,amount,mixed,none,word\n"
        "1,true,2020-01-02,2020-01-02 03:04:05.5,1.5,1,NA,\n"
        "2,False,,2020-01-03 00:00:00,2,x,,a b\n"
    )
    folder = write(tmp_path, stores=text, employees="EMPLOYEEID,HireDate,FirstName\n5,2013-06-22 13:20:18.080,Ann\n")
    (tmp_path / "notes.txt").write_text("not a table")
    (tmp_path / "other.CSV").write_text("not\na table")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.csv").write_text("not\na table")
    target = str(tmp_path / "out")
    assert csv_to_parquet(spark, folder, target, CsvOptions(allow_absent=True)) == {"employees": {"rows": 1}, "stores": {"rows": 2}}

    stores = spark.read.parquet(f"{target}/stores.parquet")
    assert dict(stores.dtypes) == {
        "id": "bigint", "flag": "boolean", "day": "date", "at": "timestamp_ntz", "amount": "double",
        "mixed": "string", "none": "string", "word": "string",
    }
    assert [tuple(row) for row in stores.selectExpr("id", "word", "none").orderBy("id").collect()] == [
        (1, "", "NA"), (2, "a b", ""),
    ]
    employees = spark.read.parquet(f"{target}/employees.parquet")
    assert dict(employees.dtypes) == {"EmployeeID": "bigint", "HireDate": "timestamp_ntz", "FirstName": "string"}


def test_bad_values_fail_or_are_counted(spark, tmp_path):
    folder = write(tmp_path, categories="CategoryID,CategoryName\n1,a\nten,b\n3.5,c\n")
    with pytest.raises(Exception, match="categories.CategoryID: bad value"):
        csv_to_parquet(spark, folder)
    counts = csv_to_parquet(spark, folder, options=CsvOptions(strict=False))
    assert counts == {"categories": {"rows": 3, "malformed": 0, "CategoryID": 2}}
    assert values(RawFiles(spark, folder)["categories"]) == [(1, "a"), (None, "b"), (None, "c")]


def test_malformed_rows_fail_or_are_counted(spark, tmp_path):
    folder = write(tmp_path, categories="CategoryID,CategoryName\n1,a\n2\n3,c,d\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        csv_to_parquet(spark, folder)
    assert csv_to_parquet(spark, folder, options=CsvOptions(strict=False))["categories"]["malformed"] == 2


def test_a_table_may_be_a_directory_of_part_files(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).selectExpr("id AS CategoryID", "concat('c', id) AS CategoryName")
    df.write.option("header", True).csv(f"{tmp_path}/categories.csv")
    assert csv_tables(spark, str(tmp_path)) == {"categories": f"{tmp_path}/categories.csv"}
    assert csv_to_parquet(spark, str(tmp_path)) == {"categories": {"rows": 100}}
    assert values(RawFiles(spark, str(tmp_path))["categories"]) == values(df)


def test_external_tables_over_ingested_files(spark, tmp_path):
    texts = {
        "sales": SALES,
        "products": "ProductID,ProductName,ModifyDate\n381,Tea,2018-02-16 08:21:49.190\n",
        "employees": "EmployeeID,Gender\n6,F\n",
        "customers": "CustomerID,Address\n2,1 Main St\n",
        "categories": "CategoryID,CategoryName\n1,Drinks\n",
        "cities": "CityID,CityName,Zipcode,CountryID\n1,Oslo,150,47\n",
        "countries": "CountryID,CountryName,CountryCode\n47,Norway,NO\n",
    }
    folder = write(tmp_path, **texts)
    csv_to_parquet(spark, folder, options=CsvOptions(allow_absent=True))
    spark.sql("CREATE DATABASE ingested")
    names = register_external(spark, folder, "ingested")
    assert names == register_external(spark, folder, "ingested")
    assert [name.split(".")[1] for name in names] == [
        "sales_ext", "products_ext", "employees_ext", "customers_ext", "categories_ext", "cities_ext", "countries_ext",
    ]
    assert {spark.catalog.getTable(name).tableType for name in names} == {"EXTERNAL"}
    assert [spark.table(name).count() for name in names] == [6, 1, 1, 1, 1, 1, 1]
    at = with_sales_times(spark.table("ingested.sales_ext")).where("SalesID = 1").selectExpr("string(SalesTimestamp)")
    assert at.first()[0] == "2018-02-05 07:38:25"


def test_a_header_without_rows(spark, tmp_path):
    folder = write(tmp_path, categories="CategoryID,CategoryName\n", stores="id,name\n")
    assert csv_to_parquet(spark, folder) == {"categories": {"rows": 0}, "stores": {"rows": 0}}
    assert RawFiles(spark, folder)["categories"].count() == 0
    assert dict(spark.read.parquet(f"{folder}/stores.parquet").dtypes) == {"id": "string", "name": "string"}


def test_a_failed_conversion_keeps_the_good_table(spark, tmp_path):
    folder = write(tmp_path, categories="CategoryID,CategoryName\n1,a\n")
    csv_to_parquet(spark, folder)
    write(tmp_path, categories="CategoryID,CategoryName\nten,b\n")
    with pytest.raises(Exception, match="bad value"):
        csv_to_parquet(spark, folder)
    assert values(RawFiles(spark, folder)["categories"]) == [(1, "a")]
    assert not [path for path in tmp_path.iterdir() if path.name.startswith("_")]


def test_a_table_without_data_files_is_refused(spark, tmp_path):
    (tmp_path / "categories.parquet").mkdir()
    with pytest.raises(FileNotFoundError, match="no data file"):
        RawFiles(spark, str(tmp_path))["categories"]


def test_part_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "countries.csv").mkdir()
    write(tmp_path / "countries.csv", a="CountryID,CountryName,CountryCode\n47,Norway,NO\n", b="CountryID,CountryCode,CountryName\n46,SE,Sweden\n")
    for strict in (True, False):
        with pytest.raises(Exception, match="CSV header does not conform"):
            csv_to_parquet(spark, str(tmp_path), options=CsvOptions(strict=strict))


def test_absent_columns_fail_or_are_counted(spark, tmp_path):
    folder = write(tmp_path, categories="CategoryId ,CategoryNm\n1,a\n")
    with pytest.raises(ValueError, match="lacks CategoryID, CategoryName"):
        csv_to_parquet(spark, folder)
    assert csv_to_parquet(spark, folder, options=CsvOptions(strict=False))["categories"]["absent"] == 2


def test_far_dates_are_misfits(spark, tmp_path):
    folder = write(tmp_path, sales="SalesID,SalesDate\n1,9999-12-31\n2,2018-01-01\n")
    counts = csv_to_parquet(spark, folder, options=CsvOptions(strict=False))
    assert counts["sales"]["SalesDate"] == 1 and counts["sales"]["rows"] == 2
    with pytest.raises(Exception, match="bad value"):
        csv_to_parquet(spark, folder, options=CsvOptions(allow_absent=True))


def test_line_breaks_and_given_types(spark, tmp_path):
    folder = write(tmp_path, categories='CategoryID,CategoryName\n1,"a\nb"\n', stores="id,size\n1,007\n")
    options = CsvOptions(multiline=True, types={"stores": {"id": "double", "size": "string"}})
    csv_to_parquet(spark, folder, options=options)
    assert values(RawFiles(spark, folder)["categories"]) == [(1, "a\nb")]
    assert values(spark.read.parquet(f"{folder}/stores.parquet")) == [(1.0, "007")]


def test_external_tables_elsewhere_are_refused(spark, tmp_path):
    csv_to_parquet(spark, write(tmp_path, categories="CategoryID,CategoryName\n1,a\n"))
    register_external(spark, str(tmp_path), "elsewhere")
    with pytest.raises(ValueError, match="exists with location"):
        register_external(spark, f"{tmp_path}/other", "elsewhere")

"""Splitting of CSV files with line breaks in quoted values, against Python's parser and one that reads whole files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from salesmart.sinks.staging import Area
from salesmart.sources import csv_records as records
from salesmart.sources.csv_ingest import PARSERS, CsvOptions, csv_to_parquet

VALUES = ["", "a", "a,b", 'say "x"', "two\nlines", '"', '""\n"', "\n", ",\n,", "word " * 30, 'x"\n\n"y', "é\r\nü"]


def random_rows(count, seed):
    draw = random.Random(seed)
    return [[str(i), *(draw.choice(VALUES) for _ in range(2))] for i in range(count)]


def as_csv(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["id", "one", "two"], *rows])
    return out.getvalue()


@pytest.fixture
def small_splits(settings):
    def split(size):
        settings(spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1")

    return split


def converted(spark, folder):
    options = CsvOptions(multiline=True, types={"stores": {"id": "bigint", "one": "string", "two": "string"}})
    counts = csv_to_parquet(spark, str(folder), options=options)
    rows = spark.read.parquet(f"{folder}/stores.parquet").orderBy("id", "one").collect()
    assert counts["stores"]["rows"] == len(rows)
    return [[str(row["id"]), row["one"], row["two"]] for row in rows]


@pytest.mark.parametrize(("size", "end", "seed"), [(64, "\n", 1), (997, "\r\n", 2), (100_000, "\n", 3)])
def test_one_file_read_by_many_tasks(spark, tmp_path, small_splits, size, end, seed):
    rows = random_rows(400, seed)
    (tmp_path / "stores.csv").write_text(as_csv(rows, end), newline="")
    small_splits(size)
    lines = records._lines(spark, f"{tmp_path}/stores.csv")
    if size < 1000:
        assert lines.select("start").distinct().count() > 8
        assert lines.rdd.getNumPartitions() > 1
    assert converted(spark, tmp_path) == rows


def test_shuffled_lines_when_there_are_too_many_splits_to_broadcast(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(records, "BROADCAST_SPLITS", 1)
    rows = random_rows(300, 4)
    (tmp_path / "stores.csv").write_text(as_csv(rows), newline="")
    small_splits(200)
    assert converted(spark, tmp_path) == rows


def test_many_files_with_the_same_starts(spark, tmp_path, small_splits):
    (tmp_path / "stores.csv").mkdir()
    rows = random_rows(300, 5)
    for part in range(3):
        (tmp_path / "stores.csv" / f"{part}.csv").write_text(as_csv(rows[part * 100 : part * 100 + 100]), newline="")
    small_splits(300)
    assert converted(spark, tmp_path) == rows


def test_a_value_over_many_splits_and_quotes_inside_plain_values(spark, tmp_path, small_splits):
    long = "line, with \"quotes\"\n" * 200
    rows = [["1", '5" pipe', 'a"b"c'], ["2", long, "after"], ["3", "\n" * 50, '"\n"'], ["4", "end", "x"]]
    text = as_csv(rows).replace('"5"" pipe"', '5" pipe').replace('"a""b""c"', 'a"b"c')
    assert '1,5" pipe,a"b"c\n' in text
    (tmp_path / "stores.csv").write_text(text + "\n  \n\r\n", newline="")
    small_splits(128)
    assert converted(spark, tmp_path) == rows


def test_other_headers_and_malformed_rows(spark, tmp_path):
    (tmp_path / "stores.csv").mkdir()
    (tmp_path / "stores.csv" / "a.csv").write_text('id,one,two\n1,"x\ny",z\n')
    (tmp_path / "stores.csv" / "b.csv").write_text("id,two,one\n2,x,y\n")
    for strict in (True, False):
        with pytest.raises(Exception, match="CSV header does not conform"):
            csv_to_parquet(spark, str(tmp_path), options=CsvOptions(multiline=True, strict=strict))
    (tmp_path / "stores.csv" / "b.csv").write_text('id,one,two\n2,x\n3,"a\nb",c,d\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        csv_to_parquet(spark, str(tmp_path), options=CsvOptions(multiline=True))
    counts = csv_to_parquet(spark, str(tmp_path), options=CsvOptions(multiline=True, strict=False))
    assert counts["stores"]["rows"] == 3 and counts["stores"]["malformed"] == 2


@pytest.mark.parametrize("held", [0, 40])
def test_pieces_too_long_for_the_first_scan(spark, tmp_path, small_splits, monkeypatch, held):
    monkeypatch.setattr(records, "HELD_BYTES", held)
    rows = random_rows(300, 6)
    (tmp_path / "stores.csv").write_text(as_csv(rows))
    small_splits(200)
    assert converted(spark, tmp_path) == rows


def test_text_is_scanned_twice_and_no_line_carries_its_file_name(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "stores.csv").write_text(as_csv(random_rows(300, 7)))
    small_splits(300)
    scans, with_states = [], records._with_states
    monkeypatch.setattr(records, "_with_states", lambda *given: scans.append(1) or with_states(*given))
    area = Area(spark)
    try:
        found = records.csv_records(spark, f"{tmp_path}/stores.csv", area)
        assert found.count() == 301 and len(scans) == 1
    finally:
        area.remove()
    lines = records._lines(spark, f"{tmp_path}/stores.csv")
    assert dict(lines.dtypes) == {"file": "bigint", "start": "bigint", "length": "bigint", "value": "string"}


def test_two_files_under_one_number_are_an_error(spark):
    rows = [("f", 0, 10, False, True), ("f", 0, 10, False, True)]
    with pytest.raises(Exception, match="same number and start"):
        records.split_states(spark.createDataFrame(rows, records._EFFECT)).collect()


def test_states_follow_from_the_splits_before(spark):
    effects = [(False, True), (True, False), (True, False), (True, True), (True, False), (False, False), (False, True), (True, True)]
    expected, state = [], False
    for outside, inside in effects:
        after = inside if state else outside
        expected.append((state, after))
        state = after
    rows = [("f", i * 10, 10, *effect) for i, effect in enumerate(effects)] + [("g", 0, 10, False, True)]
    found = records.split_states(spark.createDataFrame(rows, records._EFFECT)).orderBy("file", "start").collect()
    assert [(row["inside"], row["inside_after"]) for row in found] == [*expected, (False, False)]


def test_an_empty_table_and_nothing_left_behind(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("id,one,two\n")
    area = Area(spark)
    try:
        found = records.csv_records(spark, f"{tmp_path}/stores.csv", area)
        assert [tuple(row) for row in found.collect()] == [(True, "id,one,two")]
        assert found.where(F.col("first")).count() == 1
    finally:
        area.remove()
    assert converted(spark, tmp_path) == []


def test_dates_go_straight_to_the_cast_that_takes_them(spark):
    """A failed cast costs some 20 times one that fits, so a date must not be tried as a number first."""
    parser = PARSERS["nanos"]
    assert parser.index("RLIKE") < parser.index("AS bigint))") and not parser.startswith("coalesce")
    day = 9190 * 86_400 * 10**9
    expected = {
        "1995-03-01": day,
        "1995-03-01 00:00:01": day + 10**9,
        "1995-03-01T00:00:01.123456789": day + 1_123_456_789,
        "1995-03-01 02:00:00+02:00": day,
        "1995-03-01 00:00:00Z": day,
        "9999-12-31": None,
        "1995-02-30": None,
        " 12 ": 12,
        "-5": -5,
        "1.5": None,
        "x": None,
    }
    texts = spark.createDataFrame([(text,) for text in expected], "text string")
    found = {row["text"]: row["nanos"] for row in texts.selectExpr("text", f"{parser.format(text='text')} AS nanos").collect()}
    assert found == expected

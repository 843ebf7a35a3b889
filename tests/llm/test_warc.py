"""Archives: exact round trips, the frame layout, and damaged input."""

import hashlib
import struct

import pytest
import zstandard

from salesmart.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload_digest string, refers_to string"


def archived(spark, rows, tmp_path, **how):
    folder = str(tmp_path / "archive")
    warc.archive_pages(spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA), folder, **how)
    return folder, {r["page_id"]: r for r in warc.read_archives(spark, folder).collect()}


def test_round_trip_and_revisits(spark, tmp_path):
    long = "<p>" + "repeated passage " * 20
    rows = [(i, f"http://h/{i}", f"<html>{i} {'é' * i}</html>") for i in range(200)]
    rows += [(500 + i, "http://h/copy", long) for i in range(60)] + [(400, None, long)]
    rows += [(600, "u", None), (601, "u", ""), (602, "u", "short"), (603, "u", "short"), (-5, "a b", "z" * 100), (-4, "a b", "z" * 100)]
    rows += [(700, "u", "\r\n\r\n" + "v" * 300_000)]
    folder, found = archived(spark, rows, tmp_path)
    assert len(found) == len(rows)
    first = {}
    for page, _, html in sorted(rows):
        first.setdefault(html or "", page)
    for page, url, html in rows:
        payload, row = (html or "").encode(), found[page]
        revisit = len(payload) >= 100 and first[html] != page
        assert row["payload_bytes"] == len(payload)
        assert row["payload_digest"] == hashlib.sha256(payload).hexdigest()
        assert (row["record_type"], row["refers_to"]) == (("revisit", first[html]) if revisit else ("response", None))
        assert (row["payload"] is None) if revisit else (bytes(row["payload"]) == payload)
    files = list((tmp_path / "archive").glob("part-*"))
    for file in files:
        data = file.read_bytes()
        assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY_MAGIC
    assert sum(len(list(warc.frames(f.read_bytes()))) for f in files) == len(rows)


def test_few_pages_need_no_dictionary_and_an_empty_table_no_archive(spark, tmp_path):
    _, found = archived(spark, [(1, "u", "x" * 200), (None, "u", "no id")], tmp_path / "few")
    assert set(found) == {1}
    folder, found = archived(spark, [], tmp_path / "none")
    assert found == {}


def record(payload=b"<html/>", page=1):
    return warc.build_record(page, "http://h/", payload, hashlib.sha256(payload).hexdigest(), None, "2024-01-01T00:00:00Z")


def archive(records, dictionary=None, packed=False):
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    lead = b""
    if dictionary:
        lead = warc.dictionary_frame(zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary)
    one = zstandard.ZstdCompressor(dict_data=known)
    return lead + b"".join(one.compress(r) + warc.EMPTY_SKIPPABLE for r in records)


def test_dictionary_plain_or_compressed():
    dictionary = zstandard.train_dictionary(2048, [record(b"<html>%d</html>" % i * 20, i) for i in range(200)]).as_bytes()
    records = [record(b"<html>%d</html>" % i, i) for i in range(5)]
    for packed in (False, True):
        assert list(warc.frames(archive(records, dictionary, packed))) == records


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1", 1), "no WARC header"),
        (lambda r: r.replace(b"WARC-Date", b"WARC-Dote", 1), "missing headers"),
        (lambda r: r[:-2], "does not match the record"),
        (lambda r: r[:-4] + b"\r\n\r.", "two line breaks"),
        (lambda r: r.replace(b"<html/>", b"<htm1/>"), "digest"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: metadata"), "unexpected record"),
    ],
)
def test_records_that_are_not_well_formed(change, message):
    with pytest.raises(ValueError, match=message):
        warc.parse_record(change(record()))


def test_damaged_archives_fail_or_are_reported(spark, tmp_path):
    good, bad = record(), record().replace(b"<html/>", b"<htm1/>")
    data = archive([good, bad, good])
    (tmp_path / "part-0").write_bytes(data[:-12])
    with pytest.raises(Exception, match="digest"):
        warc.read_archives(spark, str(tmp_path)).collect()
    errors = [r["error"] for r in warc.read_archives(spark, str(tmp_path), strict=False).collect()]
    assert errors[0] is None and "digest" in errors[1] and "cut short" in errors[2]


def test_large_ids_beside_nulls(spark, tmp_path):
    page = "x" * 200
    rows = [(2**60 + 1, "u", page), (2**60 + 3, "u", page), (5, "u", "other")]
    folder = str(tmp_path / "archives")
    warc.archive_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1), folder)
    found = {r["page_id"]: r["refers_to"] for r in warc.read_archives(spark, folder).collect()}
    assert found == {2**60 + 1: None, 2**60 + 3: 2**60 + 1, 5: None}

from __future__ import annotations

import hashlib

import pytest

from tablegate.llm import warc

BIG = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 60
ROWS = [
    (1, "http://a", BIG), (7, "http://b", BIG), (4, "http://c\r\nx: y z", BIG), (None, "http://d", BIG), (7, "http://b", BIG),
    (2, "http://e", "small"), (3, None, "small"), (5, "http://f", None), (6, "http://g", ""), (None, None, None),
    (8, "http://h", "x" * 999), (9, "http://h", "x" * 999), (10, "h", "x" * 1000), (11, "h", "x" * 1000), (12, "long", "ab\n" * 400_000),
]


def test_archives_give_back_what_was_written(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 AS path", "2 AS digest", "3 AS payload")
    index = warc.write(pages, warc.archive_folder(spark))
    got = warc.read(index, with_payload=True).collect()
    assert len(got) == len(ROWS) == index.count()
    last: dict[bytes, int] = {}
    for page_id, _, html in ROWS:
        body = (html or "").encode()
        if page_id is not None and len(body) >= 1000:
            last[body] = max(page_id, last.get(body, page_id))
    want = []
    for page_id, _, html in ROWS:
        body = (html or "").encode()
        refers = last.get(body) if last.get(body) != page_id else None
        kind = "response" if refers is None else "revisit"
        want.append((page_id, len(body), hashlib.sha1(body).hexdigest(), kind, refers, None if refers else body))
    key = lambda r: tuple(str(x) for x in r)
    mine = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(mine, key=key) == sorted(want, key=key)


def test_selected_records_only(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    index = warc.write(pages, warc.archive_folder(spark))
    assert [r.page_id for r in warc.read(index.filter("page_id = 10")).collect()] == [10]
    assert warc.read(index.filter("false")).count() == 0


def test_no_pages(spark):
    index = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), warc.archive_folder(spark))
    assert index.count() == 0 and warc.read(index).count() == 0


def test_near_ranges_are_read_together():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP, 5), ("a", 21 + 2 * warc.GAP, 5), ("b", 0, warc.SPAN), ("b", warc.SPAN, 1)]
    got = list(warc.spans(places))
    assert [x[3:] for x in got] == [(0, 3), (3, 4), (4, 5), (5, 6)]
    assert got[0][:3] == ("a", 0, 20 + warc.GAP)


def test_damage_is_found(spark, tmp_path):
    body = warc.record(1, "u", b"abc", hashlib.sha1(b"xyz").hexdigest(), None)
    import gzip

    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(body))
    rows = [(1, "u", 3, "", "response", None, str(path), 0, path.stat().st_size)]
    with pytest.raises(Exception, match="damaged"):
        warc.read(spark.createDataFrame(rows, warc.INDEX)).collect()

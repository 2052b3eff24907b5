import gzip

import duckdb
import pytest
from corpus import with_clashes

from compare import differences
from shelfrank.llm import oracles, store, warc

PAGES = "page_id long, url string, html string"


def rows():
    found = [(k, f"http://h.example/{k}", f"<p>{k % 7 if k % 2 else k}</p>") for k in range(40)]
    found += [
        (100, None, None), (101, "http://x/", ""), (102, "http://a\r\nInjected: yes/", "<p>é😀</p>\r\n\r\n<b>"),
        (103, "http://y/", "\x00"), (104, "http://z/", "line\nline" * 5000),
    ]
    return found


def captured(spark, pages, folder, **settings):
    warc.write_archives(pages, str(folder), **settings)
    return warc.read_archives(spark, str(folder))


def test_resolved_records_equal_the_oracle(spark, tmp_path):
    records = captured(spark, spark.createDataFrame(rows(), PAGES).repartition(3), tmp_path / "w")
    got = warc.resolve_revisits(records).drop("url").toPandas()
    connection = duckdb.connect()
    connection.execute("create table pages (page_id bigint, url varchar, html varchar)")
    connection.executemany("insert into pages values (?, ?, ?)", rows())
    assert differences(got, connection.execute(oracles.ARCHIVES).df()) is None


def test_payloads_come_back_and_revisits_hold_none(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 500)
    records = captured(spark, spark.createDataFrame(rows(), PAGES), tmp_path / "w").collect()
    html = {page_id: (text or "").encode() for page_id, _, text in rows()}
    by_record = {r["record_id"]: r for r in records}
    assert len(records) == len(by_record) == len(rows())
    for r in records:
        original = by_record[r["refers_to_record"]] if r["record_type"] == "revisit" else r
        assert original["record_type"] == "response"
        assert bytes(original["payload"]) == html[r["page_id"]]
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
    urls = {r["page_id"]: r["url"] for r in records}
    assert urls[100] is None and urls[102] == "http://a%0D%0AInjected:%20yes/"


def test_small_payloads_can_stay_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], PAGES)
    records = warc.resolve_revisits(captured(spark, pages, tmp_path / "w", least_bytes=3)).collect()
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in records}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_members_are_plain_gzip_with_fresh_headers(spark, tmp_path):
    folder = str(tmp_path / "w")
    manifest = warc.write_archives(spark.createDataFrame(rows()[:3], PAGES), folder, date="2020-01-01T00:00:00Z")
    files = [r["archive"] for r in manifest.collect()]
    text = b"".join(gzip.decompress(store.read_range(f, 0, 10**6)) for f in files)
    assert text.count(b"WARC/1.1\r\n") == 3 and text.count(b"WARC-Date: 2020-01-01T00:00:00Z\r\n") == 3


def test_damage_raises(spark, tmp_path):
    folder = str(tmp_path / "w")
    row = warc.write_archives(spark.createDataFrame(rows()[:1], PAGES), folder).first()
    member = gzip.decompress(store.read_range(row["archive"], 0, row["bytes"]))
    with pytest.raises(ValueError, match="damaged"):
        warc._parsed(gzip.compress(member.replace(b"<p>", b"<q>")))


def test_edge_cases(spark, tmp_path):
    odd = [(None, "u", "same"), (7, "u", "same"), (7, "u", "same"), (3, "u", "same"), (None, None, "alone")]
    pages = with_clashes(spark.createDataFrame(odd, PAGES))
    found = warc.resolve_revisits(captured(spark, pages, tmp_path / "a")).collect()
    got = sorted(((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0, r["payload_bytes"]) for r in found))
    assert got == [
        (0, "response", 0, 5), (0, "revisit", 7, 4), (3, "revisit", 7, 4),
        (7, "response", 0, 4), (7, "response", 0, 4),
    ]
    assert warc.resolve_revisits(captured(spark, pages.limit(0), tmp_path / "b")).count() == 0

import hashlib

from deltafolio.llm import queries, warc


def plain(rows):
    pages = [(k, (h or "").encode()) for k, h in rows]
    out = []
    for k, payload in pages:
        first = min(i for i, p in pages if p == payload)
        revisit = len(payload) >= 100 and k != first
        out.append((k, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out)


def archive_rows(pages):
    return sorted((int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], int(r["refers_to"]) if r["refers_to"] else None) for r in warc.read(warc.write(pages)).collect())


ODD = [(5, "u", "x" * 100), (3, None, "x" * 100), (4, "u\r\nEvil: 1", "x" * 99), (6, "u", "x" * 99), (1, "u", None), (2, "u", ""), (7, "u", "ñ" * 50), (8, "u", "ñ" * 50), (9, "u", "long " * 100000), (9, "u", "long " * 100000)]


def test_odd_pages(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in ODD], "page_id bigint, url string, html string, digest string")
    assert archive_rows(pages) == plain([(k, h) for k, _, h in ODD])
    assert archive_rows(pages.limit(0)) == []


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = sorted(tuple(r) for r in queries.op8_warc_archive(spark, sf_dir).collect())
    assert got == plain([(r["page_id"], r["html"]) for r in pages.collect()])


def test_records_come_back_byte_for_byte(spark):
    pages = spark.createDataFrame([(1, "http://a", "y" * 200), (2, "http://b", "y" * 200), (3, "http://c", "z")], "page_id bigint, url string, html string")
    archive = warc.write(pages)
    assert archive.payloads.count() == 2
    rows = {r["page_id"]: r for r in warc.reconstruct(archive).collect()}
    assert bytes(rows["2"]["payload"]) == b"y" * 200
    head, body = bytes(rows["1"]["record"]).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"Content-Length: 200" in head and body == b"y" * 200 + b"\r\n\r\n"
    assert b"WARC-Refers-To: <urn:page:1>" in bytes(rows["2"]["record"]) and bytes(rows["2"]["record"]).endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n")


def test_a_damaged_payload_raises(spark):
    import pytest

    archive = warc.write(spark.createDataFrame([(1, "u", "abc")], "page_id bigint, url string, html string"))
    broken = archive._replace(payloads=spark.createDataFrame([(archive.payloads.first()["digest"], bytearray(b"abd"))], "digest string, payload binary"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read(broken).collect()


def test_ids_of_any_text_and_rows_without_ids(spark):
    big = "q" * 150
    rows = [("a>b", "u", big), ("", "u\r\nX: 1", big), ("50%3E\r\n", "u", big), (None, "u", big), ("%", None, "w" * 120), (None, "u", "only nulls " * 20), (None, "v", "only nulls " * 20), ("a>b", "u", "other")]
    found = warc.read(warc.write(spark.createDataFrame(rows, "page_id string, url string, html string"))).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in found), key=str)
    wanted = [("a>b", 150, "revisit", ""), ("", 150, "response", None), ("50%3E\r\n", 150, "revisit", ""), (None, 150, "revisit", ""), ("%", 120, "response", None)]
    wanted += [(None, 220, "response", None), (None, 220, "response", None), ("a>b", 5, "response", None)]
    assert got == sorted(wanted, key=str)
    nulls = spark.createDataFrame([(None, "u", big), (None, "u", big)], "page_id bigint, url string, html string")
    archive = warc.write(nulls)
    assert [(r["page_id"], r["record_type"]) for r in warc.read(archive).collect()] == [(None, "response")] * 2 and archive.payloads.count() == 1


def test_one_id_with_two_payloads(spark):
    rows = [(1, "u", "a" * 100), (1, "u", "b" * 100), (2, "u", "a" * 100), (2, "u", "b" * 100)]
    assert archive_rows(spark.createDataFrame(rows, "page_id bigint, url string, html string")) == plain([(k, h) for k, _, h in rows])

"""ARC archives that this library did not write, and the files that it writes."""

import datetime as dt
import gzip
import zlib

from chartlake.llm import arc_warc

LATIN = "<p>caf\xe9 \xdf</p>".encode("latin-1")


def foreign():
    """Version 1: an HTTP page in Latin-1, a dns answer, a bare HTTP head with line feeds only, a block that looks like none of them."""
    version = arc_warc._version_block(1)
    blocks = [
        ("http://a/caf\xe9".encode("latin-1"), b"19970801123456", b"text/html", b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n" + LATIN),
        (b"dns:a.example", b"19970801123457", b"text/dns", b"19970801123457\na.example. 60 IN A 192.0.2.7\n"),
        (b"http://b/", b"19970801123458", b"text/html", b"HTTP/1.0 404\nServer: x\xff\nContent-Length: 999\n\nmissing"),
        (b"http://c/", b"19970801123459", b"image/gif", b"HTTP/1.0 200 OK"),
        (b"http://d/", b"bad", b"text/plain", b"\x00\xff\r\n\r\nWARC/1.1\r\n"),
    ]
    return version + b"".join(b" ".join([u, b"192.0.2.1", d, t, str(len(x)).encode()]) + b"\n" + x + b"\n" for u, d, t, x in blocks)


def test_foreign_records_keep_their_bytes(spark):
    rows = list(arc_warc.parse_arc(foreign()))
    assert [r["payload"] for r in rows] == [LATIN, b"19970801123457\na.example. 60 IN A 192.0.2.7\n", b"missing", b"", b"\x00\xff\r\n\r\nWARC/1.1\r\n"]
    assert [r["status"] for r in rows] == [200, None, 404, 200, None] and all(r["page_id"] is None for r in rows)
    for content in (foreign(), gzip.compress(foreign())):
        archives = spark.createDataFrame([(bytearray(content),)], "content binary")
        folder = arc_warc.shared_folder(spark, "warc")
        arc_warc.write_warc(arc_warc.to_warc(arc_warc.read_arc(archives)), folder)
        back = {r.url: r for r in arc_warc.read_warc(spark, folder).collect()}
        assert len(back) == 5
        assert {r.payload_digest for r in back.values()} == {r["payload_digest"] for r in rows}
        assert all(r.payload_digest == r.body_digest for r in back.values())
        assert {u: r.record_type for u, r in back.items() if u[:4] != "http" or "/d" in u} == {"dns:a.example": "resource", "http://d/": "resource"}
        assert back["dns:a.example"].warc_date == "1997-08-01T12:34:57Z" and back["http://d/"].warc_date == "bad"
        assert back["http://b/"].payload_bytes == 7 and back["http://c/"].payload_bytes == 0


def test_equal_payloads_of_foreign_records(spark):
    version = arc_warc._version_block(1)
    block = b"HTTP/1.0 200 OK\r\n\r\n" + LATIN
    record = b"http://a/ 192.0.2.1 19970801123456 text/html %d\n" % len(block) + block + b"\n"
    dns = b"dns:a 192.0.2.1 19970801123456 text/dns 4\nname\n"
    archives = spark.createDataFrame([(bytearray(version + record + record + dns + dns),)], "content binary")
    folder = arc_warc.shared_folder(spark, "warc")
    arc_warc.write_warc(arc_warc.to_warc(arc_warc.read_arc(archives)), folder)
    # without ids nothing is larger: ties are all responses
    assert sorted(r.record_type for r in arc_warc.read_warc(spark, folder).collect()) == ["resource", "resource", "response", "response"]


def members(data):
    """The plain bytes of each gzip member."""
    out = []
    while data:
        one = zlib.decompressobj(31)
        out.append(one.decompress(data))
        assert one.eof
        data = one.unused_data
    return out


def test_files_are_cut_by_bytes_with_a_member_a_record(spark, tmp_path):
    sizes = sorted([10] * 300 + [5_000] * 40 + [200_000] * 3, reverse=True)  # the large ones stand together
    pages = spark.createDataFrame([(i, "u", "x" * n + str(i)) for i, n in enumerate(sizes)], "page_id long, url string, html string").coalesce(1)
    folder = str(tmp_path / "warc")
    arc_warc.write_warc(arc_warc.to_warc(arc_warc.records_of(pages)), folder, 100_000)
    found = [members(f.read_bytes()) for f in (tmp_path / "warc").glob("part-*")]
    assert all(x[-1] == b"" and all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in x[:-1]) for x in found)
    assert sum(len(x) - 1 for x in found) == len(sizes)
    assert all(sum(map(len, x)) <= 100_000 + 201_000 + 400 * len(x) for x in found) and len(found) >= 6
    assert arc_warc.read_warc(spark, folder).count() == len(sizes)
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "warc").glob("part-*"))
    assert len(list(arc_warc.parse_warc(whole))) == len(sizes)


def test_dates_of_pages_and_long_texts(spark):
    rows = [(1, "u", "x" * 6_000_000, dt.datetime(2001, 2, 3, 4, 5, 6)), (2, "u", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, seen timestamp")
    back = {r.page_id: r for r in arc_warc.convert(pages, date_col="seen")[0].collect()}
    assert back[1].warc_date == "2001-02-03T04:05:06Z" and back[1].payload_bytes == 6_000_000
    assert back[2].warc_date == "2026-01-01T00:00:00Z" and back[2].payload_bytes == 0


def test_gunzip_takes_many_members():
    parts = [bytes([i % 256]) * (i % 50) for i in range(5000)]
    assert arc_warc.gunzip(b"".join(map(arc_warc._gzip, parts))) == b"".join(parts)

"""Archives: both ARC versions, their conversion, and what is read back."""

import base64
import gzip
import hashlib
import io
import re

import pytest

from millrace.llm import warc

PAGES = [
    (5, "http://a.example/x y?z=1", "<p>same</p>"),
    (3, "http://a.example/é", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (None, "http://n.example/", "<p>same</p>"),
    (4, "http://b.example/", None),
    (8, "http://b.example/2", ""),
    (6, "http://c.example/", "unlike\r\n\r\nWARC/1.1\r\n\x00 é 漢"),
    (7, "http://c.example/long", "y" * 3_000_000),
    (7, "http://c.example/long", "y" * 3_000_000),
    (-2, "http://c.example/neg", "alone"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least):
    groups = {}
    for i, (page, _, html) in enumerate(rows):
        if len((html or "").encode()) >= least:
            groups.setdefault(html or "", []).append((page is None, page or 0, i))
    first = {k: min(v) for k, v in groups.items()}
    out = []
    for i, (page, _, html) in enumerate(rows):
        n = len((html or "").encode())
        own = n < least or first[html or ""][2] == i
        refers = None if own else rows[first[html or ""][2]][0]
        out.append((page, n, digest(html), "response" if own else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_pages_come_back(spark, least):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, record string").repartition(4)
    got = warc.page_archive(pages, revisit_bytes=least).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(PAGES, least)


def test_empty(spark):
    assert warc.page_archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def arc(version, records, packed=False):
    out = [warc.arc_head(version, f"old-v{version}.arc", "19990102030405")]
    for url, kind, body in records:
        out.append(warc.arc_line(version, url, "1.2.3.4", "199901020304", kind, len(body), "old.arc", 7) + body + b"\n")
    return b"".join(gzip.compress(x) for x in out) if packed else b"".join(out)


HTTP = b"HTTP/1.0 200 OK\r\nX-Page-Id: 12\r\n\r\nhello"


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_old_archives_are_converted(spark, tmp_path, version, packed):
    records = [("http://a.example/with space", "text/html", HTTP), ("dns:a.example", "text/dns", b"A 1.2.3.4")]
    path = tmp_path / f"old-{version}{'.gz' if packed else ''}"
    path.write_bytes(arc(version, records, packed))
    files = warc.convert(warc.arc_files(spark, str(path))).collect()
    with warc.reader(files[0]["warc"]) as f:
        found = list(warc.warc_records(f, "x"))
    kinds = [h["warc-type"] for h, _ in found]
    assert kinds == ["warcinfo", "response", "resource"]
    head, block = found[1]
    assert block == HTTP and head["warc-target-uri"] == "http://a.example/with space"
    assert head["warc-date"] == "1999-01-02T03:04:00Z" and head["warc-ip-address"] == "1.2.3.4"
    assert head["warc-payload-digest"] == "sha1:" + digest("hello")
    again = warc.convert(warc.arc_files(spark, str(path))).collect()
    with warc.reader(again[0]["warc"]) as f:
        assert list(warc.warc_records(f, "x")) == found


def test_archives_of_one_inner_name_keep_their_records_apart(spark, tmp_path):
    """Two files with the same name, inner name and places; each revisit refers to the one response of its payload."""
    def page(i, body):
        return ("http://a.example/", "text/html", f"HTTP/1.0 200 OK\r\nX-Page-Id: {i}\r\n\r\n{body}".encode())

    for folder, records in {"a": [page(1, "x"), page(2, "y")], "b": [page(3, "y"), page(4, "x"), page(5, "z")]}.items():
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "old.arc").write_bytes(arc(1, records))
    files = warc.convert(warc.arc_files(spark, f"{tmp_path}/*/old.arc"))
    names = []
    for r in files.collect():
        with warc.reader(r["warc"]) as f:
            names += [h["warc-record-id"] for h, _ in warc.warc_records(f, "x")]
    assert len(names) == len(set(names)) == 7
    rows = warc.read_warcs(files).collect()
    page_of = {r["record"].strip("<>"): r["id"] for r in rows}
    found = sorted((r["id"], r["type"], page_of.get((r["refers"] or "").strip("<>"))) for r in rows)
    assert found == [(1, "response", None), (2, "response", None), (3, "revisit", 2), (4, "revisit", 1), (5, "response", None)]


@pytest.mark.parametrize("spoil", [lambda a: a[:-3], lambda a: re.sub(rb"text/html \d+", b"text/html -1", a), lambda a: b"junk\n" + a])
def test_damaged_archives_raise(spoil):
    data = spoil(arc(1, [("http://a.example/", "text/html", HTTP)]))
    with pytest.raises(ValueError):
        list(warc.arc_records(io.BytesIO(data), "x"))

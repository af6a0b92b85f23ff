"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import one_task_each
from millrace.llm.files import new_file, open_file
from millrace.session import scratch_dir, staged

# The header lines of both versions of the format, and the fields of a record's line.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ID_HEADER = "X-Page-Id"
FILE_BYTES = 64 << 20  # a file is closed once it holds this much payload


def member(data: bytes) -> bytes:
    """One gzip member: archives hold one per record, so that each can be read on its own."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def reader(uri: str):
    """The archive's bytes, unpacked if it is packed."""
    f = open_file(uri)
    packed = f.read(2) == b"\x1f\x8b"
    f.seek(0)
    return io.BufferedReader(gzip.GzipFile(fileobj=f) if packed else f, 1 << 20)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ARC ---------------------------------------------------------------------------------------------


def arc_line(version: int, url: str, ip: str, date: str, kind: str, length: int, name: str, at: int) -> bytes:
    fields = [url, ip, date, kind] + (["200", "-", "-", str(at), name] if version == 2 else []) + [str(length)]
    return " ".join(fields).encode("ascii") + b"\n"


def arc_head(version: int, name: str, date: str) -> bytes:
    block = f"{version} 0 millrace\n{ARC_FIELDS[version]}\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(block), name, 0) + block


@dataclass
class ArcRecord:
    version: int
    name: str  # of the archive, as its first record says
    seq: int
    url: str
    ip: str
    date: str
    kind: str
    body: bytes


def arc_records(f, uri: str) -> Iterator[ArcRecord]:
    """Records of an ARC file in either version; its first line and version block say which.

    A record's line has 5 fields in version 1 and 10 in version 2, counted from the right, as old crawlers
    left spaces in addresses.  The body is as long as the line declares; blank lines between records
    are skipped.  A line that does not parse or a body that is cut off raises with the place.
    """
    version, name, seq = 0, "", -1
    while line := f.readline():
        if not line.strip():
            continue
        seq += 1
        if seq == 0:
            if not line.startswith(b"filedesc://"):
                raise ValueError(f"{uri} does not begin like an ARC file")
            name = line.split(b" ")[0][len(b"filedesc://") :].decode("latin-1")
        width = len(ARC_FIELDS[version or 1].split())
        parts = line.rstrip(b"\r\n").rsplit(b" ", width - 1)
        try:
            length = int(parts[-1])
            if len(parts) != width or length < 0:
                raise ValueError
        except ValueError:
            raise ValueError(f"{uri}, record {seq}: {line[:200]!r} is no header of version {version}") from None
        body = f.read(length)
        if len(body) != length:
            raise ValueError(f"{uri}, record {seq}: {len(body)} of {length} bytes")
        if seq == 0:
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{uri}: version {version}")
            continue
        # A first line of version 2 has all ten fields too; counted as five, the address keeps the rest.
        url, ip, date, kind = (p.decode("latin-1") for p in parts[:4])
        yield ArcRecord(version, name, seq, url, ip, date, kind, body)


def write_arcs(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               date: str = "20240101000000") -> DataFrame:
    """Write `pages` as ARC files, a row per file: (arc).  Tasks write versions 1 and 2 in turn.

    The payload is the html in UTF-8 (null: empty) behind the response headers, which carry the page's id
    (left out if null).  White space in an address is percent-encoded; a null address is `about:blank`.
    """
    folder = scratch_dir(pages.sparkSession, "arc")

    def run(batches):
        part = TaskContext.get().partitionId()
        version, files, out, size = 1 + part % 2, 0, None, 0
        uri = name = ""
        for b in batches:
            for page, url, html in zip(*(b[c].to_pylist() for c in ("id", "url", "html"))):
                if out is None or size > FILE_BYTES:
                    if out:
                        out.close()
                        yield pa.record_batch([[uri]], names=["arc"])
                    name = f"pages-{part:05d}-{files:05d}.arc"
                    uri, out = new_file(folder, name[:-4], ".arc.gz")
                    out.write(member(arc_head(version, name, date)))
                    files, size = files + 1, 0
                html = html or b""
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += f"Content-Length: {len(html)}\r\n" + (f"{ID_HEADER}: {page}\r\n" if page is not None else "")
                body = head.encode() + b"\r\n" + html
                address = quote(url if url else "about:blank", safe="%/:=&?~#+!$,;'@()*[]")
                line = arc_line(version, address, "0.0.0.0", date, "text/html", len(body), name, size)
                out.write(member(line + body + b"\n"))
                size += len(body)
        if out:
            out.close()
            yield pa.record_batch([[uri]], names=["arc"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("binary").alias("html"))
    return staged(rows.mapInArrow(run, "arc string"), "arcs")


def arc_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(arc) for ARC files that are already there."""
    return spark.read.format("binaryFile").load(pattern).select(F.col("path").alias("arc"))


# Conversion --------------------------------------------------------------------------------------


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(headers with the blank line, payload); a body that is no HTTP response is payload only."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    head, gap, rest = body.partition(b"\r\n\r\n")
    if not gap:
        head, gap, rest = body.partition(b"\n\n")
    return head + gap, rest


def header(head: bytes, name: str) -> str | None:
    for line in head.decode("latin-1").splitlines()[1:]:
        key, colon, value = line.partition(":")
        if colon and key.strip().lower() == name.lower():
            return value.strip()
    return None


def warc_date(arc_date: str) -> str:
    """14 digits, or the 12 of early crawlers, as an ISO time; anything else raises."""
    d = arc_date.ljust(14, "0") if len(arc_date) == 12 else arc_date
    if len(d) != 14 or not d.isdigit():
        raise ValueError(f"no archive date: {arc_date!r}")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def record_id(uri: str, archive: str, seq: int) -> str:
    """The same for the same place in the same archive, so a rerun writes the same identifiers.

    Old crawlers gave many archives one inner name, so the file's address is part of it.
    """
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri}|{archive}#{seq}')}"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    fields = [*fields, ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    return head.encode("latin-1") + b"\r\n" + block + b"\r\n\r\n"


INDEX = "arc string, seq int, record string, id long, bytes long, digest string"


def index(arcs: DataFrame) -> DataFrame:
    """A row per record: where it is, its identifier, page id, payload size and digest."""

    def run(batches):
        for b in batches:
            for uri in b["arc"].to_pylist():
                rows = []
                with reader(uri) as f:
                    for r in arc_records(f, uri):
                        head, payload = split_http(r.body)
                        page = header(head, ID_HEADER)
                        page = int(page) if page and page.lstrip("-").isdigit() else None
                        rows.append((uri, r.seq, record_id(uri, r.name, r.seq), page, len(payload), sha1(payload)))
                if rows:
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), INDEX_TYPES)], names=INDEX_NAMES)

    return staged(one_task_each(arcs).mapInArrow(run, INDEX), "index")


INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
INDEX_TYPES = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def convert(arcs: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Write a WARC file for every ARC file: (warc).

    Of records with equal payloads of at least `revisit_bytes`, that with the smallest page id (nulls last,
    then the place) is the response; the others become revisits of it, with headers and no payload.
    That choice is made on digests alone, taken map-side first, so payloads never move.  A record
    that is no HTTP response becomes a resource.  A task takes one ARC file and its records' choices.
    """
    folder = scratch_dir(arcs.sparkSession, "warc")
    rows = index(arcs)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("record"))
    first = rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest", "bytes").agg(F.min(order)["record"].alias("first"))
    choice = rows.join(first, ["digest", "bytes"], "left").select(
        "arc", "seq", F.when(F.col("first") != F.col("record"), F.col("first")).alias("first")
    )

    def write(table: pa.Table) -> pa.Table:
        arc = table["arc"][0].as_py()
        refers = dict(zip(table["seq"].to_pylist(), table["first"].to_pylist()))
        uri, out = new_file(folder, arc.rpartition("/")[2].partition(".")[0], ".warc.gz")
        with out, reader(arc) as f:
            for n, r in enumerate(arc_records(f, arc)):
                date = warc_date(r.date)
                if n == 0:
                    info = f"software: millrace\r\nformat: WARC File Format 1.1\r\nisPartOf: {r.name}\r\n".encode()
                    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id(arc, r.name, 0)}>"), ("WARC-Date", date)]
                    out.write(member(warc_record([*fields, ("Content-Type", "application/warc-fields")], info)))
                head, payload = split_http(r.body)
                first = refers[r.seq]
                kind = "revisit" if first else "response" if head else "resource"
                fields = [
                    ("WARC-Type", kind),
                    ("WARC-Record-ID", f"<{record_id(arc, r.name, r.seq)}>"),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", r.url),
                    ("WARC-IP-Address", r.ip),
                    ("Content-Type", "application/http; msgtype=response" if head else r.kind),
                    ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"),
                ]
                if first:
                    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    fields += [("WARC-Profile", profile), ("WARC-Refers-To", f"<{first}>")]
                out.write(member(warc_record(fields, head if first else r.body)))
        return pa.table({"warc": [uri]})

    # Choices are few bytes; the number of tasks is that of the files they are about.
    dealt = choice.repartition(max(1, arcs.count()), "arc")
    return staged(dealt.groupBy("arc").applyInArrow(write, "warc string"), "warcs")


# Reading -----------------------------------------------------------------------------------------


def warc_records(f, uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record."""
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{uri}: {line[:100]!r} begins no record")
        fields = {}
        while (line := f.readline()).strip():
            key, _, value = line.decode("latin-1").partition(":")
            fields[key.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = f.read(length)
        if len(block) != length:
            raise ValueError(f"{uri}: a record of {length} bytes is cut off")
        yield fields, block


RECORD = "record string, type string, refers string, id long, payload_bytes long, payload_digest string"
RECORD_TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def read_warcs(warcs: DataFrame) -> DataFrame:
    """A row per response, resource or revisit record, read from the files; digests are checked.

    A revisit's size and digest are those of the full payload, from its headers.
    """

    def run(batches):
        for b in batches:
            for uri in b["warc"].to_pylist():
                rows = []
                with reader(uri) as f:
                    for fields, block in warc_records(f, uri):
                        kind = fields["warc-type"]
                        if kind == "warcinfo":
                            continue
                        head, payload = split_http(block)
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "revisit":
                            size = int(header(head, "Content-Length") or 0)
                        else:
                            size = len(payload)
                            if sha1(payload) != digest:
                                raise ValueError(f"{uri}: {fields['warc-record-id']} is damaged")
                        page = header(head, ID_HEADER)
                        refers = fields.get("warc-refers-to")
                        rows.append((
                            fields["warc-record-id"].strip("<>"), kind, refers and refers.strip("<>"),
                            int(page) if page is not None else None, size, digest,
                        ))
                if rows:
                    columns = [pa.array(x, t) for x, t in zip(zip(*rows), RECORD_TYPES)]
                    yield pa.record_batch(columns, names=[c.split()[0] for c in RECORD.split(", ")])

    return one_task_each(warcs).mapInArrow(run, RECORD)


def page_archive(pages: DataFrame, revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """Archive `pages` as ARC, convert to WARC, read back: (id, payload_bytes, payload_digest, record_type, refers_to).

    One row per page; refers_to is the id of the response a revisit points to, found through its record
    identifier.  Null html is an empty payload; a null id stays null and comes last when a response
    is chosen; repeated rows are records of their own.  Empty input gives no rows.
    """
    found = staged(read_warcs(convert(write_arcs(pages, id_col, url_col, html_col), revisit_bytes)), "records")
    target = found.where("type <> 'revisit'").select(F.col("record").alias("refers"), F.col("id").alias("refers_to"))
    return found.join(target, "refers", "left").select(
        "id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )

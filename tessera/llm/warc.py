"""WARC archives with an index written first, and reads of the records that the index selects.

*Writing.*  One pass over the rows.  A task writes its records to archives of
bounded size in the given folder and hands one index row per record to Spark:
archive, offset, length, URL, digest and type.  The index is a table of its
own; an archive of a failed or repeated task attempt is in no index row, so it
is never read.  Equal payloads of at least ``MIN_REVISIT_BYTES`` are stored once,
with the largest id; the others are ``revisit`` records that refer to it.  Which
digests repeat is known from an aggregate over digests, never over payloads.

*Reading.*  Records are selected in the index alone.  Their byte ranges are
dealt by archive and segment of ``SEGMENT_BYTES``, sorted by offset, and ranges
closer than ``GAP_BYTES`` become one read; nothing else of an archive is read.

The folder must be one that all executors reach (``spark.checkpoint.dir`` for
the registered query).  Workers open it through ``pyarrow.fs`` by its URI
(``file``, ``hdfs``, ``s3``, ``gs``).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, small_side, written

#: Payloads of fewer bytes are always stored.
MIN_REVISIT_BYTES = 1000
#: An archive is closed once it holds this many bytes.
ARCHIVE_BYTES = 1 << 30
#: Bytes of an archive that one task reads in a row, and bytes of records per task.
SEGMENT_BYTES = 8 << 20
TASK_BYTES = 128 << 20
#: Two ranges this close are read as one, up to ``READ_BYTES`` at a time.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Bytes of payloads in a batch that a reading task gives back.
OUT_BYTES = 8 << 20

#: Fixed values of the format (WARC 1.1).
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, archive string, offset long, length long"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
_URI_SAFE = "!#$%&'()*+,/:;=?@[]~"


def _open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", uri) else (pafs.LocalFileSystem(), uri)


def _record_uri(page_id: int | None) -> str:
    return f"urn:page:{page_id}" if page_id is not None else uuid.uuid4().urn


def record_bytes(page_id: int | None, url: str | None, payload: bytes, hex_digest: str, refers_to: int | None) -> bytes:
    """A record: its header, the HTTP header and, unless it refers to another record, the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{_record_uri(page_id)}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),  # the rows carry no time; equal inputs give equal records
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", quote(url, safe=_URI_SAFE)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{_record_uri(refers_to)}>"), ("WARC-Profile", PROFILE)]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-case names), HTTP header and payload of one record; a damaged record is an error."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is not {size} bytes long")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, http, payload


def _page_of(field: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", field or "")
    return int(found[1]) if found else None


class _Archives:
    """The archives of one task attempt."""

    def __init__(self, folder: str, compress: bool) -> None:
        self.fs, self.base = _open_folder(folder)
        self.compress = compress
        self.out: BinaryIO | None = None
        self.name, self.at = "", 0

    def put(self, record: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}.warc{'.gz' if self.compress else ''}", 0
            self.out = self.fs.open_output_stream(posixpath.join(self.base, self.name), compression=None)
        data = gzip.compress(record, 6, mtime=0) if self.compress else record
        place = (self.name, self.at, len(data))
        self.out.write(data)
        self.at += len(data)
        if self.at >= ARCHIVE_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def with_types(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url, payload, payload_digest, payload_bytes, refers_to`` (null: the record holds its payload).

    Digests met once need no join partner; the repeated ones are an aggregate
    that combines in the map tasks, so a payload that a third of all rows share
    is one row per task there.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    large = rows.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).select("payload_digest", "page_id")
    first = large.groupBy("payload_digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
    first = written(first.where("n > 1 AND newest IS NOT NULL").select("payload_digest", "newest"), "payloads")
    met = rows.join(small_side(first), "payload_digest", "left")
    other = F.col("newest").isNotNull() & ~F.col("newest").eqNullSafe(F.col("page_id"))
    return met.select("page_id", "url", "payload", "payload_digest", "payload_bytes", F.when(other, F.col("newest")).alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", compress: bool = False
) -> DataFrame:
    """Writes a record per row to archives in ``folder``; returns the index to be written by the caller.

    The index has one row per record: ``page_id, url, record_type, refers_to,
    payload_digest, payload_bytes, archive, offset, length``.  It must be
    written once and read from there: computing it again writes new archives.
    A null payload is empty; a record with a null id gets an id of its own; rows
    with the largest id of a payload all hold it; without any id all hold it.
    ``compress`` makes every record a gzip member.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, compress)
        try:
            for batch in batches:
                places, kinds = [], []
                ids, urls, refers = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(5).to_pylist()
                for i, (page, url, hexed, target) in enumerate(zip(ids, urls, batch.column(3).to_pylist(), refers)):
                    record = record_bytes(page, url, batch.column(2)[i].as_py(), hexed, target)
                    places.append(archives.put(record))
                    kinds.append("response" if target is None else "revisit")
                name, at, length = zip(*places) if places else ([], [], [])
                new = [pa.array(name, pa.string()), pa.array(at, pa.int64()), pa.array(length, pa.int64())]
                old = [batch.column(i) for i in (0, 1)] + [pa.array(kinds, pa.string())] + [batch.column(i) for i in (5, 3, 4)]
                yield pa.RecordBatch.from_arrays(old + new, names)
        finally:
            archives.close()

    names = [c.split()[0] for c in _INDEX.split(", ")]
    _open_folder(folder)[0].create_dir(_open_folder(folder)[1], recursive=True)
    return arrow_map(with_types(pages, id_col, url_col, html_col), rows, _INDEX)


def _ranges(rows: list[dict]) -> Iterator[tuple[str, int, int, list[dict]]]:
    """Archive, start, end and rows of every read; ``rows`` are sorted by archive and offset."""
    group: list[dict] = []
    for row in rows:
        if group:
            end = group[-1]["offset"] + group[-1]["length"]
            near = row["archive"] == group[0]["archive"] and row["offset"] <= end + GAP_BYTES
            if not near or row["offset"] + row["length"] - group[0]["offset"] > READ_BYTES:
                yield group[0]["archive"], group[0]["offset"], end, group
                group = []
        group.append(row)
    if group:
        yield group[0]["archive"], group[0]["offset"], group[-1]["offset"] + group[-1]["length"], group


def _read_back(row: dict, record: bytes) -> tuple:
    fields, http, payload = parse_record(gzip.decompress(record) if row["archive"].endswith(".gz") else record)
    kind = fields["warc-type"]
    size = int(re.search(rb"(?im)^content-length:[ \t]*(\d+)", http)[1])
    hexed = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != hexed or len(payload) != size):
        raise ValueError(f"{row['archive']} at {row['offset']}: the payload does not match its digest")
    return _page_of(fields["warc-record-id"]), row["url"], kind, _page_of(fields.get("warc-refers-to")), hexed, size, payload


def read_records(selected: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of the selected index rows, parsed from their bytes: ``page_id, url, record_type, refers_to,
    payload_digest, payload_bytes`` and, if wanted, ``payload`` (null for a revisit).

    Payloads are held against their digests.  Several rows of one record give
    as many rows and one read per task.  An empty selection gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_folder(folder)
        opened: tuple[str, pa.NativeFile] | None = None
        found: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*found))[: len(schema)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        try:
            for batch in batches:
                for archive, start, end, group in _ranges(batch.to_pylist()):
                    if opened is None or opened[0] != archive:
                        if opened is not None:
                            opened[1].close()
                        opened = archive, fs.open_input_file(posixpath.join(base, archive))
                    data = opened[1].read_at(end - start, start)
                    for row in group:
                        at = row["offset"] - start
                        record = _read_back(row, data[at : at + row["length"]])
                        found.append(record[:6] + (record[6] if payload and record[2] == "response" else None,))
                        held += len(record[6]) if payload else 0
                        if held >= OUT_BYTES or len(found) >= 10_000:
                            yield out()
                            found, held = [], 0
            if found:
                yield out()
        finally:
            if opened is not None:
                opened[1].close()

    wanted = _RECORD if payload else _RECORD.rsplit(", ", 1)[0]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([pa.field(n, kinds[t]) for n, t in (c.split() for c in wanted.split(", "))])
    places = selected.select("url", "archive", "offset", "length")
    size = places.agg(F.sum("length")).first()[0] or 0
    # by number: index rows are few bytes, and their count must not decide how many tasks read
    parts = max(selected.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES + 1)
    segment = F.floor(F.col("offset") / F.lit(SEGMENT_BYTES))
    dealt = places.repartition(parts, "archive", segment).sortWithinPartitions("archive", "offset")
    return arrow_map(dealt, rows, wanted)


def with_payloads(index: DataFrame, folder: str, selected: DataFrame | None = None) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload`` of the selected index rows (default: all).

    A revisit gets the payload of its original; rows of equal payloads cost one
    read together.  Selected rows of which the index has no stored payload are an
    empty join, which cannot happen in an index of :func:`write_archives`.
    """
    rows = index if selected is None else selected
    key = ["payload_digest", "payload_bytes"]
    place = F.min(F.struct("archive", "offset", "length", "url")).alias("at")
    stored = index.where("record_type = 'response'").join(rows.select(*key).distinct(), key, "left_semi")
    once = written(stored.groupBy(*key).agg(place).select("at.*"), "selected")
    payloads = read_records(once, folder).select(*key, "payload")
    return rows.join(payloads, key).select("page_id", "url", "record_type", "refers_to", "payload")

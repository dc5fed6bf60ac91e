import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, warc
from tessera.llm.tables import written
from tests.conftest import SF_SMALL

BIG = "<p>" + "long enough ä € 😀 " * 80 + "</p>"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (1, "http://a.b/x", BIG),
        (7, "http://a.b/y", BIG),
        (7, "http://a.b/y", BIG),  # a repeated row
        (None, "http://a.b/z", BIG),
        (3, None, BIG),
        (4, "http://a.b/ü \r\nWARC-Type: bad", BIG + "x"),
        (5, "", "short"),
        (6, "http://c.d/", "short"),
        (8, "http://c.d/n", None),
        (9, "http://c.d/e", ""),
        (None, None, None),
        (10, "http://c.d/w", "\r\n\r\nWARC/1.1\r\n\r\n" * 90),
        (11, "http://c.d/l", "z" * 3_000_000),
        (None, "http://e.f/1", "only ids that are null " * 60),
        (None, "http://e.f/2", "only ids that are null " * 60),
    ]
    return spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "page_id long, url string, html string, offset int, archive string, n int")


def wanted(rows):
    newest = {}
    for r in rows:
        if r["page_id"] is not None and len((r["html"] or "").encode()) >= 1000:
            newest[r["html"]] = max(r["page_id"], newest.get(r["html"], r["page_id"]))
    out = []
    for r in rows:
        data = (r["html"] or "").encode()
        target = newest.get(r["html"])
        again = target is not None and target != r["page_id"]
        out.append((r["page_id"], r["url"], "revisit" if again else "response", target if again else None, hashlib.sha1(data).hexdigest(), len(data)))
    return sorted(out, key=str)


def archive_of(spark, pages, **options):
    folder = tempfile.mkdtemp(prefix="tessera-warc-")
    return written(warc.write_archives(pages, folder, **options), "warc-index"), folder


@pytest.mark.parametrize("compress", [False, True])
def test_odd_rows_round_trip(spark, odd_pages, compress):
    index, folder = archive_of(spark, odd_pages, compress=compress)
    rows = odd_pages.collect()
    assert sorted((tuple(r)[:6] for r in index.collect()), key=str) == wanted(rows)
    read = warc.read_records(index, folder).collect()
    assert sorted((tuple(r)[:6] for r in read), key=str) == wanted(rows)
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in read)
    whole = warc.with_payloads(index, folder).collect()
    assert sorted(((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in whole), key=str) == sorted(
        ((r["page_id"], r["url"], r["html"] or "") for r in rows), key=str
    )


def test_index_places_are_the_archives_bytes(spark, odd_pages):
    index, folder = archive_of(spark, odd_pages)
    for r in index.collect():
        with open(os.path.join(folder, r["archive"]), "rb") as f:
            f.seek(r["offset"])
            fields, _, payload = warc.parse_record(f.read(r["length"]))
        assert fields["warc-type"] == r["record_type"]
        assert payload == b"" or hashlib.sha1(payload).hexdigest() == r["payload_digest"]
    sizes = {r["archive"]: r["size"] for r in index.groupBy("archive").agg(F.sum("length").alias("size")).collect()}
    assert all(os.path.getsize(os.path.join(folder, a)) == n for a, n in sizes.items())


def test_selected_records_read_only_their_ranges(spark, odd_pages):
    index, folder = archive_of(spark, odd_pages.where("page_id IN (5, 6, 10, 11)").coalesce(1))
    kept = index.where("page_id IN (5, 10)").collect()
    # the other bytes of the archive are overwritten: reading them would fail
    for name in {r["archive"] for r in kept}:
        path = os.path.join(folder, name)
        with open(path, "rb") as f:
            data = bytearray(f.read())
        clean = bytearray(b"#" * len(data))
        for r in kept:
            clean[r["offset"] : r["offset"] + r["length"]] = data[r["offset"] : r["offset"] + r["length"]]
        with open(path, "wb") as f:
            f.write(clean)
    got = warc.read_records(index.where("page_id IN (5, 10)"), folder).collect()
    assert sorted(r["page_id"] for r in got) == [5, 10]
    with pytest.raises(Exception, match="WARC record|bytes long"):
        warc.read_records(index, folder).collect()


def test_ranges_are_coalesced():
    row = lambda a, o, n: {"archive": a, "offset": o, "length": n}
    gap, most = warc.GAP_BYTES, warc.READ_BYTES
    rows = [row("a", 0, 10), row("a", 10, 10), row("a", 10, 10), row("a", 20 + gap, 5), row("a", 26 + 2 * gap, 5), row("b", 0, 3), row("b", 3, most)]
    got = [(a, s, e, len(g)) for a, s, e, g in warc._ranges(rows)]
    assert got == [("a", 0, 25 + gap, 4), ("a", 26 + 2 * gap, 31 + 2 * gap, 1), ("b", 0, 3, 1), ("b", 3, 3 + most, 1)]


def test_archives_are_closed_at_their_size(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    folder = tempfile.mkdtemp(prefix="tessera-warc-")
    a = warc._Archives(folder, False)
    places = [a.put(b"x" * 900) for _ in range(7)]
    a.close()
    assert [p[1] for p in places] == [0, 900, 1800, 0, 900, 1800, 0]
    assert len({p[0] for p in places}) == 3


def test_damage_is_found(spark, odd_pages):
    index, folder = archive_of(spark, odd_pages.where("page_id = 11"))
    r = index.first()
    with open(os.path.join(folder, r["archive"]), "r+b") as f:
        f.seek(r["offset"] + r["length"] - 500)
        f.write(b"!")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_records(index, folder).collect()


def test_empty(spark, odd_pages):
    index, folder = archive_of(spark, odd_pages.limit(0))
    assert index.count() == 0
    assert warc.read_records(index, folder).count() == 0
    assert warc.with_payloads(index, folder).count() == 0


def test_query_on_pages(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()
    got = [(r["page_id"], r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for r in queries.op12_warc(spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == sorted(((w[0], *w[2:]) for w in wanted(rows)), key=str)

"""ARC to WARC conversion and sharding."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

from talentlens.llm import sharding, warc
from talentlens.llm.staging import shared_path
from talentlens.session import read_table

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"
TRICKY = [(1, "http://a b/\n", None), (2, None, ""), (3, "u", "WARC/1.0\r\n\r\nx\r\n\r\n"), (4, "u", "é\n\n\nHTTP"), (5, "u", "é\n\n\nHTTP"), (None, "u", "é\n\n\nHTTP"),
          (7, "", "http://x 0.0.0.0 2026 text/html 5\nabc\n\n"), (8, "u", "x" * 100_000), (9, "u", "\r\n\r\n"), (12, "v", "é\n\n\nHTTP")]


def plain_records(rows):
    first, out = {}, []
    key = lambda p: 1 << 62 if p is None else p
    for p, _, h in rows:
        first[h or ""] = min(first.get(h or "", 1 << 62), key(p))
    for p, _, h in rows:
        data, least = (h or "").encode(), first[h or ""]
        is_first = key(p) == least
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if is_first else "revisit", None if is_first else least))
    return sorted(out, key=str)


def test_pages_through_arc_and_warc(spark):
    got = warc.digests(spark.createDataFrame(TRICKY, PAGES).selectExpr("*", "'x' AS archive", "1 AS value"))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_records(TRICKY)


def test_all_pages(spark):
    pages = read_table(spark, SF, "pages").select("page_id", "url", "html")
    assert sorted(map(tuple, warc.digests(pages).collect()), key=str) == plain_records([tuple(r) for r in pages.collect()])
    assert warc.digests(pages.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    pages = [(p, u, (h or "").encode()) for p, u, h in TRICKY]
    records = list(warc.read_arc(warc.arc_file("a.arc", version, pages), "a.arc"))
    assert [warc._split(c)[1] for _, _, c in records] == [h for _, _, h in pages]
    names = set(warc.FIELDS[version].split())
    assert all(set(f) == names for _, f, _ in records)
    if version == 2:
        assert [int(f["Offset"]) for _, f, _ in records] == [at for at, _, _ in records]


def test_broken_archives_are_errors():
    arc = warc.arc_file("a.arc", 1, [(1, "u", b"abc")])
    for bad in (arc[:-1], b"u 0.0.0.0 20260101000000 text/html 3\nabc", arc.replace(b"text/html ", b"text/html x")):
        with pytest.raises(ValueError):
            list(warc.read_arc(bad))
    whole = warc.convert(arc, "a", {})
    with pytest.raises(ValueError):
        list(warc.read_warc(whole[:-1]))


def test_warc_records_are_equivalent(spark):
    pages = spark.createDataFrame(TRICKY, PAGES)
    arc, out = shared_path(spark, "arc"), shared_path(spark, "warc")
    warc.write_arc(pages, arc, archive_bytes=50)
    warc.convert_archives(spark, arc, out)
    files = [zlib.decompress(r.content, 47) for r in spark.read.format("binaryFile").load(out).collect()]
    assert len(files) > 3
    heads = [(h, b) for f in files for h, b in warc.read_warc(f)]
    kinds = [warc._header(h, b"WARC-Type") for h, _ in heads]
    assert kinds.count("warcinfo") == len(files) and kinds.count("revisit") == 4 and kinds.count("response") == 6
    ids = [warc._header(h, b"WARC-Record-ID") for h, _ in heads]
    assert len(set(ids)) == len(ids)
    for head, block in heads:
        assert warc._header(head, b"WARC-Date") == "2026-01-01T00:00:00Z"
        assert warc._header(head, b"WARC-Block-Digest") == "sha1:" + warc.digest(block)


def checked(rows, expected):
    assert len(rows) == expected
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    return [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]


def test_shards_of_documents(spark):
    docs = read_table(spark, SF, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = sharding.digests(docs).collect()
    sizes, most = checked(rows, len(texts)), max(r["size"] for r in rows)
    assert all(abs(s - sum(sizes) / 8) <= most + 0.02 * sum(sizes) / 8 for s in sizes)      # a document is never cut
    assert {r.doc_id: (r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None) for i, t in texts.items()}


def test_a_hot_text_is_split_and_small_groups_are_not(spark):
    rows = [(None, None)] * 40 + [(1, "aa" * 500)] * 400 + [(i, f"t{i % 200}" * 50) for i in range(600)]
    got = sharding.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes = checked(got, len(rows))
    assert max(sizes) < 1.05 * sum(sizes) / 8 and min(sizes) > 0.95 * sum(sizes) / 8
    by_text = {}
    for r in got:
        by_text.setdefault(r.text_crc32, set()).add(r.shard)
    assert len(by_text[zlib.crc32(b"aa" * 500)]) >= 5
    assert sum(len(s) > 1 for s in by_text.values()) == 1


def test_shards_of_little(spark):
    one = spark.createDataFrame([(1, "a", "x", 5)], "doc_id long, text string, shard string, h int")
    row = sharding.shard(one).first()
    assert (row.slot, row.h, row["size"]) == (0, 5, 2) and row.shard in range(8)
    assert sharding.digests(one.limit(0)).count() == 0


def test_range_of_tied_keys():
    bounds = np.array([(3, -(1 << 63)), (5, -(1 << 63)), (5, 10), (5, 20), (9, -(1 << 63))], np.int64)
    h, k = np.array([1, 3, 5, 5, 5, 7, 9]), np.array([0, -7, 9, 10, 99, 0, 0])
    assert sharding.range_of(h, k, bounds).tolist() == [0, 1, 2, 3, 4, 4, 5]

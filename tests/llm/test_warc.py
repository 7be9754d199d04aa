import gzip
import hashlib
import io
import zlib

import pyarrow as pa
import pytest

from scorefold.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, size string, least int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 3) for r in rows], SCHEMA).repartition(3)


def odd():
    big = "<p>é</p>" * 40
    return [
        (1, "http://a/b c\r\nX: y", big), (2, None, big), (3, "http://a", big), (3, "http://a", big), (None, "http://n", big), (9, "http://s", "short"),
        (8, "http://s", "short"), (4, "u", None), (5, "u", ""), (6, "u", "x" * 300_000), (7, "u", "\r\n\r\nWARC/1.1\r\n\x1f" * 30), (-5, "neg", "y" * 200),
    ]


@pytest.mark.parametrize("split", [64, 777, 1 << 20])
def test_round_trip(spark, split):
    data = odd()
    out = warc.archived(spark, pages(spark, data), split).collect()
    assert len(out) == len(data)
    body = {(i, (h or "").encode()) for i, _, h in data}
    first = {}
    for i, _, h in data:
        p = (h or "").encode()
        if i is not None:
            first[p] = min(first.get(p, i), i)
    digests = {hashlib.sha256(p).hexdigest(): p for _, p in body}
    for r in out:
        p = digests[r.payload_digest]
        assert (r.page_id, p) in body and r.payload_bytes == len(p)
        revisit = len(p) >= 100 and r.page_id != first[p]
        assert (r.record_type, r.refers_to) == (("revisit", first[p]) if revisit else ("response", None))
        assert bytes(r.payload) == (b"" if revisit else p)


def test_members_stand_alone(spark, tmp_path):
    files = warc.write_archives(pages(spark, odd()), f"file://{tmp_path}/w", file_bytes=500).collect()
    assert sum(f.records for f in files) == len(odd()) and len(files) > 3
    whole = b"".join(gzip.open(f.path.removeprefix("file://")).read() for f in files)
    assert whole.count(b"WARC-Type: ") == len(odd()) and b"\r\nX: y" not in whole.replace(b"%0D%0AX:%20y", b"")


def reader(data):
    return warc._Reader(pa.PythonFile(io.BytesIO(data), "r"))


def member(i, payload):
    return warc._member(warc.record(i, "u", payload, len(payload), "0", None))


def test_ranges_share_out_records_and_false_magic():
    # magic bytes, and the start of a gzip member, inside stored payloads
    inner = gzip.compress(b"WARC/1.1 no record")[:40]
    parts = []
    for i in range(12):
        body = warc.record(i, "u", warc.MAGIC * 5 + inner, 15 + len(inner), "0", None)
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        parts.append(packer.compress(body) + packer.flush())
    data, starts = b"".join(parts), [sum(map(len, parts[:i])) for i in range(12)]
    for step in (50, 301, 5000):
        seen = [x.offset for a in range(0, len(data), step) for x in reader(data).records(a, min(len(data), a + step))]
        assert seen == starts


def test_damage_raises():
    data = member(1, b"a" * 500) + member(2, b"b") + b"junk"
    with pytest.raises(ValueError):
        list(reader(data).records(0, len(data)))
    with pytest.raises(ValueError):
        list(reader(b"junk" + member(1, b"a")).records(0, 5))


def test_empty(spark):
    assert warc.archived(spark, pages(spark, [])).count() == 0

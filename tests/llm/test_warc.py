import struct
import time

import pytest
import zstandard

from tickloom.llm import warc as w
from tickloom.llm.common import written


def want(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw, f = (h or "").encode(), first.get(h or "")
        revisit = len(raw) >= least and f is not None and (i is None or i > f)
        out.append((i, len(raw), w.sha1_base32(raw), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


ROWS = [(5, "http://a/", "same é"), (3, "http://b/ \n x", "same é"), (9, None, None), (8, "u", ""), (7, "u", "x" * 3_000_000), (None, "u", "same é"), (None, "v", "only null"), (None, "v", "only null"), (2, "w", "twice"), (2, "w", "twice"), (4, "w", "twice"), (1, "é", "a\r\n\r\nb")]
ROWS += [(100 + i, f"http://h/{i}", f"<p>text number {i % 40} " + f"of some page {i % 40} " * 200) for i in range(200)]


@pytest.mark.parametrize("least", [0, 7])
def test_round_trip(spark, least):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    archives = written(w.write_archives(df, least=least, archive_bytes=300_000), "archives")
    assert all(struct.unpack_from("<I", r.content)[0] == w.DICT_MAGIC for r in archives.collect())
    got = w.read_archives(archives).collect()
    assert all(r.record_error is None for r in got)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == want(ROWS, least)
    assert {(r.page_id, bytes(r.payload).decode()) for r in got if r.record_type == "response"} <= {(i, h or "") for i, _, h in ROWS}


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_hot_payload_over_many_partitions(spark, broadcast):
    """Half of all rows share a payload, in 211 partitions; digests broadcast or dealt by salt."""
    rows = [(i, f"http://h/{i % 7}", "hot payload " * 50 if i % 2 else f"page {i % 300}") for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(211)
    got = w.read_archives(w.write_archives(df, broadcast_digests=broadcast), payload=False).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == want(rows)


def test_many_small_frames_take_time_in_proportion():
    body = [w.record(i, "u", b"x", 1, w.sha1_base32(b"x"), None) for i in range(20_000)]
    archive = w.compress(body, w.dictionary(body[:3]))
    began = time.perf_counter()
    assert sum(1 for _ in w.frames(archive)) == 20_000
    assert time.perf_counter() - began < 10
    with pytest.raises(w.WarcError):
        list(w.frames(archive, max_record=100))


def test_query(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 AS size", "2 AS payload")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(map(tuple, w.op1_warc(spark, str(tmp_path)).collect()), key=str) == want(ROWS)
    df.limit(0).write.parquet(f"{tmp_path}/e/pages.parquet")
    assert w.op1_warc(spark, f"{tmp_path}/e").count() == 0
    sf = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, w.op1_warc(spark, sf).collect()), key=str) == want(rows)


def test_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    w.save(w.write_archives(df, archive_bytes=300_000), f"file://{tmp_path}/arc")
    files = spark.read.format("binaryFile").load(f"{tmp_path}/arc").select("path", "content")
    got = w.read_archives(files)
    assert got.columns[0] == "path"
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()], key=str) == want(ROWS)


def frame(content, **options):
    return zstandard.ZstdCompressor(**options).compress(content)


def test_plain_dictionary():
    body = [w.record(i, "u", b"some text of a page " * 20, 400, w.sha1_base32(b"some text of a page " * 20), None) for i in range(40)]
    for raw in (zstandard.train_dictionary(4096, body * 20).as_bytes(), b"raw content of a dictionary: some text of a page " * 10):
        tool = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        archive = struct.pack("<II", w.DICT_MAGIC, len(raw)) + raw + b"".join(map(tool.compress, body)) + struct.pack("<II", 0x184D2A50, 3) + b"pad"
        assert list(w.frames(archive)) == body


def test_broken_archives(spark):
    good = w.record(1, "u", b"pay", 3, w.sha1_base32(b"pay"), None)
    assert w.read_record(good)["payload"] == b"pay"
    for old, new in ((b"WARC/1.1", b"WARC/9.9"), (b"pay", b"paX"), (b"pay", b"payy"), (b"WARC-Type: ", b"WARC Type: "), (b"WARC-Date: ", b"WARC-Dote: "), (b"X-Payload-Length: 3", b"X-Payload-Length: 4"), (b"HTTP/1.1", b"GOPH/1.1")):
        with pytest.raises(w.WarcError):
            w.read_record(good.replace(old, new))
    one = frame(good)
    cases = {"cut": one + one[:-3], "junk": one + b"junkjunkjunk", "tail": one + b"x", "checksum": one[:-6] + b"abc" + one[-3:], "unknown": frame(good, write_content_size=False), "dict": struct.pack("<II", w.DICT_MAGIC, 99) + one, "bad": frame(b"no warc") + one, "empty": b"", "null": None}
    df = spark.createDataFrame([(k, v if v is None else bytearray(v)) for k, v in cases.items()], "name string, content binary")
    got = {}
    for r in w.read_archives(df).collect():
        got.setdefault(r.name, []).append(r.record_error is None)
    assert got == {"cut": [True, False], "junk": [True, False], "tail": [True, False], "checksum": [False], "unknown": [False], "dict": [False], "bad": [False, True]}

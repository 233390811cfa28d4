from __future__ import annotations

import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from cases import CLASH, frame, odd_documents
from casecurve.llm import planes, tokens, warc


def pages(spark, rows, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in (*CLASH, "payload", "sha1", "bundle", "head")]) if clash else df


def page_rows():
    rng = random.Random(5)
    big = "<p>" + "é" * 700 + "</p>"
    rows = [(i, f"http://a.b/{i}?q= x\r\ny", big if i % 3 == 0 else "<b>" * rng.randint(0, 800)) for i in range(1, 60)]
    return rows + [(100, None, None), (101, "", ""), (102, "http://\n", "\r\n\r\n" * 400), (None, "n", big), (None, None, "q" * 2000), (57, "again", big), (57, "again", big)]


@pytest.mark.parametrize("clash,frame_bytes,bundle_bytes", [(False, 1 << 20, 1 << 30), (True, 3000, 2000)])
def test_warc(spark, tmp_path, clash, frame_bytes, bundle_bytes):
    rows = page_rows()
    index = warc.write_bundles(pages(spark, rows, clash), str(tmp_path / "w"), frame_bytes=frame_bytes, bundle_bytes=bundle_bytes)
    want = Counter()
    for key, _, html in rows:
        data = (html or "").encode()
        equal = [k for k, _, h in rows if (h or "").encode() == data and k is not None]
        head = max(equal, default=key) if len(data) >= 1000 else key
        revisit = head != key
        want[key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", head if revisit else None, None if revisit else data] += 1
    got = Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read_records(index).collect())
    assert got == want
    # Any decompressor reads a bundle from end to end.
    for name in {r.bundle for r in index.collect()}:
        with open(name, "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_a_hot_payload_and_many_empty_ones_are_spread(spark, tmp_path):
    """Half of all rows share one payload, a quarter has none: no task writes much more than its share."""
    hot = "<p>" + "".join(random.Random(1).choice("abcdefgh ") for _ in range(3000)) + "</p>"
    rows = [(i, f"u{i}", hot if i % 2 else None if i % 4 else f"{i} " * 400) for i in range(4000)]
    before = {k: spark.conf.get(k, None) for k in SPLITTING}
    try:
        for k, v in SPLITTING.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(32)
        index = warc.write_bundles(df, str(tmp_path / "w"))
        per_task = Counter(r.bundle for r in index.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(per_task.values()) == 4000 and max(per_task.values()) < 700
    got = Counter((r.record_type, r.refers_to) for r in warc.read_records(index).collect())
    assert got == Counter({("response", None): 2001, ("revisit", 3999): 1999})


def test_ids_that_look_like_none(spark, tmp_path):
    rows = [("", "u", "a"), (None, "u", "b"), (" ", "u", "c"), ("<x>", "u", "d")]
    index = warc.write_bundles(spark.createDataFrame(rows, "page_id string, url string, html string"), str(tmp_path / "w"))
    assert {(r.id, r.payload.decode()) for r in warc.read_records(index).collect()} == {(k, h) for k, _, h in rows}


@pytest.mark.parametrize("stored", [b"abcd", b"abc", b"abXd", b"abcde"])
def test_payloads_are_measured(tmp_path, stored):
    data = warc.record(1, "u", b"abcd", hashlib.sha1(b"abcd").hexdigest(), None, False, "1970-01-01T00:00:00Z")
    size = len(data) - 8 + len(stored)
    data = data[:-8].replace(f"Content-Length: {len(data) - 8 - data.index(b'HTTP/1.1') + 4}".encode(), f"Content-Length: {size - data.index(b'HTTP/1.1')}".encode(), 1) + stored + b"\r\n\r\n"
    writer = warc.BundleWriter(open(tmp_path / "b", "wb"))
    frame, offset = writer.add(data)
    writer.close()
    index = pa.RecordBatch.from_pydict({"bundle": [str(tmp_path / "b")], "frame": [frame], "offset": [offset], "length": [len(data)]})
    if stored == b"abcd":
        assert next(warc._read([index])).to_pylist()[0]["payload_bytes"] == 4
    else:
        with pytest.raises(ValueError, match="headers"):
            next(warc._read([index]))


def test_bundle_refuses_damage(tmp_path):
    path = tmp_path / "x"
    writer = warc.BundleWriter(open(path, "wb"), 100)
    places = [writer.add(bytes([i]) * 60) for i in range(5)]
    writer.close()
    reader = warc.BundleReader(pa.memory_map(str(path)))
    assert [reader.frame(f)[o : o + 60] for f, o in places] == [bytes([i]) * 60 for i in range(5)]
    with pytest.raises(ValueError):
        warc.BundleReader(pa.BufferReader(b"no table here"))


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("chunk", [1, 7, 64, 100000])
def test_planes_round_trip(unit, chunk):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 1 << int(rng.integers(1, 33)), int(rng.integers(0, 50)), dtype=np.uint64).astype("<u4") for _ in range(12)]
    sink = pa.BufferOutputStream()
    writer = planes.PlaneWriter(sink, pa.int64(), chunk, unit)
    writer.stream = Kept(sink)
    for i, ids in enumerate(docs):
        writer.add(i if i else None, ids.tobytes())
    writer.close()
    reader = planes.PlaneReader(pa.BufferReader(sink.getvalue()))
    got = [[] for _ in docs]
    for number, ids in reader.read():
        got[number] += ids.tolist()
    assert got == [d.tolist() for d in docs]
    assert reader.documents.column("id").to_pylist() == [None, *range(1, 12)]


class Kept:
    """A sink that is not closed, so that its bytes can be looked at."""

    def __init__(self, sink):
        self.write, self.close = sink.write, lambda: None


@pytest.mark.parametrize("clash,unit,chunk", [(False, "byte", 1 << 16), (True, "bit", 100)])
def test_written_ids(spark, tmp_path, clash, unit, chunk):
    rows = odd_documents()
    plain = Tokenizer.from_file(tokens.byte_bpe_path())
    files = planes.write_ids(frame(spark, rows, clash), str(tmp_path / "p"), chunk=chunk, unit=unit)
    got = planes.read_ids(files, "bigint").collect()
    texts = Counter()
    for r in rows:
        texts[r[0], np.array([*plain.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()] += 1
    assert Counter((r.id, bytes(r.ids)) for r in got) == texts
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert (r.start, r.n_tokens, r.ids_crc32) == (end, len(r.ids) // 4, zlib.crc32(r.ids))
        end += r.n_tokens
    order = [r.id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))


def test_empty(spark, tmp_path):
    files = planes.write_ids(frame(spark, [], partitions=1), str(tmp_path / "p"))
    assert planes.read_ids(files, "bigint").count() == 0
    assert warc.read_records(warc.write_bundles(pages(spark, []), str(tmp_path / "w"))).count() == 0
    with pytest.raises(ValueError):
        planes.PlaneReader(pa.BufferReader(io.BytesIO(b"x" * 40).read()))

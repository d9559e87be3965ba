"""WARC archives and shards."""

import base64
import gzip
import hashlib
import random
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from matchlake.llm import sharding, warc
from matchlake.llm.common import shared_folder

PAGES = "page_id long, url string, html string"


def written(spark, rows, **options):
    path = shared_folder(spark)
    warc.write(spark.createDataFrame(rows, PAGES).withColumn("record_type", F.lit("clash")), path, **options)
    return path, warc.read(spark, path)


def test_round_trip(spark):
    rows = [(1, "http://a.example/x y", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u\r\nX: y", "<p>é</p>"), (5, "u", "<p>é</p>"),
            (6, "u", "a" * 300000), (7, "ü", "b\x00\r\n\r\nWARC/1.1"), (7, "ü", "b\x00\r\n\r\nWARC/1.1"), (None, "n", "only null"), (None, "n", "<p>é</p>")]
    path, got = written(spark, rows)
    got = got.collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    want = []
    for i, _, h in rows:
        payload = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = max([k for k, _, x in rows if (x or "") == (h or "") and k is not None], default=None)
        refers = top if top is not None and top != i else None
        want.append((i, len(payload), digest, "response" if refers is None else "revisit", refers, payload if refers is None else None))
    seen = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(seen, key=str) == sorted(want, key=str)


def test_archives_are_plain_gzip_members(spark):
    path, _ = written(spark, [(k, f"http://h/{k}", f"page {k} " * 50) for k in range(40)], archive_bytes=2000)
    files = [p for p in Path(path.removeprefix("file:")).rglob("part-*")]
    assert len(files) > 4
    for file in files:
        data, count = file.read_bytes(), 0
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") > 0
        while data:
            member = zlib.decompressobj(31)
            text = member.decompress(data)
            assert member.eof and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            data, count = member.unused_data, count + 1
        assert count


def test_long_payloads_go_on_in_segments(spark, monkeypatch):
    monkeypatch.setattr(warc, "SEGMENT_BYTES", 1000)
    payload = random.Random(1).randbytes(4500).hex().encode()
    parts = warc.members(9, "u", payload, None)
    assert len(parts) == 9
    stream = b"".join(parts)
    for step in (1, 7, 100, len(stream)):
        page, = warc.pages_of(stream[i:i + step] for i in range(0, len(stream), step))
        assert page["payload"] == payload and page["intact"] and page["page_id"] == 9


def test_damage_is_seen():
    good = warc.members(1, "u", b"hello world", None)[0]
    text = zlib.decompress(good, 31)
    bad = zlib.compressobj(6, zlib.DEFLATED, 31)
    page, = warc.pages_of([bad.compress(text.replace(b"hello", b"jello")) + bad.flush()])
    assert not page["intact"]
    with pytest.raises(EOFError):
        list(warc.records([good[:-10]]))
    with pytest.raises(ValueError):
        bad = zlib.compressobj(6, zlib.DEFLATED, 31)
        list(warc.records([bad.compress(b"nothing\r\n\r\n") + bad.flush()]))


def test_least_revisit_and_empty_table(spark):
    _, got = written(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], revisit_bytes=4)
    assert sorted((r.page_id, r.record_type) for r in got.collect()) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]
    path = shared_folder(spark)
    warc.write(spark.createDataFrame([], PAGES), path)
    assert warc.read(spark, path).count() == 0


def shards_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.shard, []).append(r)
    for rows in out.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    return out


def test_shards_are_even(spark):
    rows = spark.range(6000).select("id", (F.pmod(F.hash("id"), F.lit(900)) + 1).cast("long").alias("size"), F.lit(7).alias("shard"), F.lit(8).alias("slot"))
    got = shards_of(sharding.shard_by_bytes(rows, 7, weight="size", group=("id",)))
    sizes = [sum(r["size"] for r in part) for part in got.values()]
    assert len(got) == 7 and sum(map(len, got.values())) == 6000
    assert max(sizes) - min(sizes) <= 2 * 900 + 2 * sharding.TOLERANCE * sum(sizes) / 7


def test_groups_stay_together_and_hot_ones_are_cut(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") < 1500, F.lit(-1)).otherwise(F.floor(F.col("id") / 3)).alias("g"), F.lit(10).alias("size"))
    got = shards_of(sharding.shard_by_bytes(rows, 8, weight="size", group=("g",), tolerance=0.02))
    sizes = [len(part) for part in got.values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 22
    where = {}
    for shard, part in got.items():
        for r in part:
            where.setdefault(r.g, set()).add(shard)
    assert len(where[-1]) >= 3 and sum(len(s) > 1 for g, s in where.items() if g != -1) <= 7


def test_equal_rows_null_weights_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_BYTES", 1000)
    rows = spark.range(999).select(F.lit("same").alias("text"), F.when(F.col("id") % 3 > 0, F.lit(100)).alias("size"))
    got = shards_of(sharding.shard_by_bytes(rows, 3, weight="size", group=("text",)))
    sizes = [sum(r["size"] or 0 for r in part) for part in got.values()]
    assert sorted(got) == [0, 1, 2] and max(sizes) - min(sizes) <= 600
    assert sharding.shard_by_bytes(rows.limit(0), 3, weight="size").columns == ["text", "size", "shard", "slot"]
    one = sharding.shard_by_bytes(rows.limit(1).withColumn("size", F.lit(0)), 3, weight="size").collect()
    assert len(one) == 1 and one[0].slot == 0

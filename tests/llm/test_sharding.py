import zlib
from collections import Counter
from dataclasses import replace

from pyspark.sql import functions as F

from astrolode.llm import sharding


def test_rows(odd_docs, odd_rows, no_docs):
    rows = sharding.shard(odd_docs).collect()
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key") for i, t in odd_rows]
    assert sorted((tuple(r)[:4] for r in rows), key=str) == sorted(want, key=str)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of_key = {}
    for r in rows:
        assert of_key.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
    assert sharding.shard(no_docs).collect() == []


def place(spark, shards, rows=24_000):
    return [r[0] for r in spark.range(rows).orderBy("id").select(
        sharding.shard_of(F.col("id"), shards).alias("s")).collect()]


def test_one_more_shard_takes_rows_only_into_itself(spark):
    before = place(spark, sharding.topology(24))
    for shards in (24, 25, 26, 30):
        now, grown = (place(spark, sharding.topology(n)) for n in (shards, shards + 1))
        moved = [b for a, b in zip(now, grown, strict=True) if a != b]
        assert set(moved) == {shards}
        assert abs(len(moved) - 24_000 / (shards + 1)) < 250
    counts = Counter(before)
    assert set(counts) == set(range(24)) and max(counts.values()) < 1.2 * min(counts.values())


def test_changed_weights_move_rows_only_there(spark):
    tree = sharding.topology(24)
    before = place(spark, tree)
    heavier = place(spark, [replace(s, weight=4.0) if s.number == 7 else s for s in tree])
    region = {s.number for s in tree if s.region == tree[7].region}
    moved = [(a, b) for a, b in zip(before, heavier, strict=True) if a != b]
    # Between two shards of other regions, and out of the heavier one, nothing moves.
    assert all(b in region and a != 7 for a, b in moved)
    assert 3.2 < Counter(heavier)[7] / Counter(heavier)[8] < 4.8
    lighter = place(spark, [replace(s, weight=0.0) if s.number == 7 else s for s in tree])
    assert 7 not in lighter


def test_any_key(spark):
    keys = spark.sql("SELECT 'a' AS k UNION ALL SELECT NULL UNION ALL SELECT NULL")
    rows = keys.select("k", sharding.shard_of(F.col("k"), sharding.topology(5)).alias("s")).collect()
    assert len({r["s"] for r in rows if r["k"] is None}) == 1
    assert all(0 <= r["s"] < 5 for r in rows)

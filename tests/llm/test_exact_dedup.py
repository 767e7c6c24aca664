import hashlib
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from astrolode.llm import exact_dedup
from astrolode.llm.binary_fuse import BinaryFuse


def expected(rows):
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for i, t in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    out, done = [], set()
    for i, t in norm:
        named = [x for x in groups[t] if x is not None]
        keep = min(named) if named else None
        kept = i == keep and t not in done
        done |= {t} if kept else set()
        out.append((i, keep, len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_odd_rows(odd_docs, odd_rows):
    got = sorted(map(tuple, exact_dedup.dedup(odd_docs).collect()), key=str)
    assert got == expected(odd_rows)


def test_empty(no_docs):
    assert exact_dedup.dedup(no_docs).collect() == []


def test_bytes_decide_where_digests_collide(odd_docs, odd_rows):
    def weak(norm):
        return F.pmod(F.crc32(F.encode(norm, "UTF-8")), F.lit(3)).cast("string")

    got = sorted((tuple(r)[:4] for r in exact_dedup.dedup(odd_docs, weak).collect()), key=str)
    assert got == sorted((r[:4] for r in expected(odd_rows)), key=str)


def test_all_columns_of_kept_documents(odd_docs, odd_rows):
    kept = exact_dedup.kept_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    want = sorted((str(r[0]) for r in expected(odd_rows) if r[3]))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_what_stays_follows_from_the_bytes_compared(docs_of, monkeypatch):
    docs = docs_of([(i, f"text {i % 3}") for i in range(60)] + [(0, "text 0"), (None, "text 1")])
    kept = exact_dedup.kept_documents(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]
    same_bytes = exact_dedup.same_bytes
    monkeypatch.setattr(exact_dedup, "same_bytes", lambda *given: same_bytes(*given).limit(0))
    apart = exact_dedup.kept_documents(docs).collect()
    assert len(apart) == 6  # one of each text in the snapshot and one in the batch
    assert sorted(r["text"] for r in apart) == sorted(f"text {i}" for i in (0, 1, 2) * 2)


def test_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    for count in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(0, 2**64, count, np.uint64)
        made = BinaryFuse.build(np.concatenate((keys, keys[:5])))
        assert made.holds(keys).all()
        other = rng.integers(0, 2**64, 50_000, np.uint64)
        assert made.holds(other).mean() < 0.01 or count == 0
    assert len(made.cells) < 1.35 * 50_000


def test_filters_of_any_size_are_built_at_the_first_seeds():
    rng = np.random.default_rng(2)
    for count in (5_000, 121_000, 180_000, exact_dedup.FILTER_KEYS, 3 * exact_dedup.FILTER_KEYS):
        keys = rng.integers(0, 2**64, count, np.uint64)
        made = BinaryFuse.build(keys)
        assert made.seed < 5
        assert made.holds(keys).all()
        assert made.holds(rng.integers(0, 2**64, 50_000, np.uint64)).mean() < 0.01


def test_several_ranges(spark, docs_of, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_KEYS", 20)
    rows = [(i, f"text {i % 150}") for i in range(400)]
    got = sorted(map(tuple, exact_dedup.dedup(docs_of(rows)).collect()), key=str)
    assert got == expected(rows)


def test_as_many_texts_as_a_filter_takes(spark):
    texts = 2 * exact_dedup.FILTER_KEYS - 14_000  # about half of them are the snapshot
    row, first = F.col("id"), F.col("id") % texts
    docs = spark.range(texts + 10_000).select(row.alias("doc_id"), first.cast("string").alias("text"))
    wrong = (F.col("keep_id") != F.col("doc_id") % texts) | (F.col("kept") != (F.col("doc_id") < texts))
    seen = exact_dedup.dedup(docs).agg(F.count(F.lit(1)), F.count_if(wrong), F.sum("group_size")).first()
    assert tuple(seen) == (texts + 10_000, 0, texts + 30_000)


def test_screen_only_lets_through_what_may_be_there(spark):
    groups = spark.range(2000).select(F.col("id").cast("string").alias("digest"))
    made = exact_dedup.filters(groups.filter("digest < 5000"), 4)
    asked = spark.range(1500, 9000).select(F.col("id").cast("string").alias("digest"))
    passed = {r["digest"] for r in exact_dedup.screen(asked, made, 4).collect()}
    assert {str(i) for i in range(1500, 2000)} <= passed
    assert len(passed) < 500 + 0.03 * 7000

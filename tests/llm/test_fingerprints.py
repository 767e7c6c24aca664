import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from astrolode.llm import fingerprints as fp


def jaccard(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """(id, n_chars, sha of the edited text, near_edited, near_next), rows in order."""
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        half = len(t) // 2
        new = (t[:-half] if half else t) + after[:half]
        d = [fp.digests(x) for x in (t, new, after)]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(),
                    round(jaccard(d[0], d[1]), 9), round(jaccard(d[0], d[2]), 9)))
    return out


def got(frame):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9),
             round(r["near_next"], 9)) for r in frame.collect()]


def test_against_sets(docs_of, conf):
    conf(shuffle__partitions="5")
    rnd = random.Random(4)
    base = " ".join(rnd.choice(["river", "stone", "of", "the"]) + str(rnd.randrange(300)) for _ in range(4000))
    rows = [(i * 7 - 30, rnd.choice([None, "", "one", base[:rnd.randrange(9000)], "é ß\n" * 40 + str(i)]))
            for i in range(80)]
    frame = fp.compare_versions(docs_of(rnd.sample(rows, len(rows))).repartition(4))
    assert sorted(got(frame)) == sorted(expected(rows))


def test_repeated_and_missing_ids(odd_docs, odd_rows, no_docs):
    rows = fp.compare_versions(odd_docs).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in odd_rows)
    prints = {}
    texts = {i: t for i, t in odd_rows if i is not None}
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] is not None:
            assert prints.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]
    assert fp.compare_versions(no_docs).collect() == []


def test_one_row_is_its_own_next(docs_of):
    assert got(fp.compare_versions(docs_of([(5, "a b\nc d")]))) == expected([(5, "a b\nc d")])
    assert len(fp.compare_versions(docs_of([(None, None), (None, "x")])).collect()) == 2


def test_sketches_give_back_the_difference():
    rng = np.random.default_rng(3)
    common = [np.unique(rng.integers(0, 2**64, n, np.uint64)) for n in (0, 5, 300, 2000)]
    a = [np.union1d(c, rng.integers(0, 2**64, k, np.uint64)) for c, k in zip(common, (0, 3, 0, 900))]
    b = [np.union1d(c, rng.integers(0, 2**64, k, np.uint64)) for c, k in zip(common, (2, 0, 70, 1))]
    for x, y, (only_x, only_y) in zip(a, b, fp.differences(a, b), strict=True):
        assert sorted(only_x) == sorted(set(x) - set(y)) and sorted(only_y) == sorted(set(y) - set(x))


def test_too_small_a_sketch_says_so():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**64, 400, np.uint64), np.empty(0, np.uint64)]
    apart = fp.subtract(fp.sketches(sets[:1], 8), fp.sketches(sets[1:], 8))
    assert not apart.whole[0]


def test_text_form_and_moved_paragraphs():
    text = " ".join(f"word{i % 91}" for i in range(900))
    keys = fp.digests(text)
    items, cells = fp.read_in(fp.written_out(len(keys), fp.sketches([keys], fp.CELLS)[0]))
    assert items == len(keys) and (cells == fp.sketches([keys], fp.CELLS)[0]).all()
    assert fp.likenesses([keys], [fp.digests("something put before " + text)])[0] > 0.9
    assert fp.likenesses([keys], [keys]) == [1.0]
    assert len(fp.digests("same line\n" * 50)) == 50


def test_every_long_text_has_several_paragraphs():
    rnd = random.Random(6)
    phrases = ["spam ", "Ating. ", "Of Of ining ", "a", "日本語", "ab\n", "x" * 70 + " ", "the very same words again and "]
    texts = [(p * 400)[:n] for p in phrases for n in (100, 101, 333, 1000)]
    texts += ["".join(rnd.choice("abcdef ") for _ in range(n)) for n in (100, 400, 3000)]
    for text in texts:
        parts = fp.paragraphs(text)
        assert len(parts) >= len(text.encode()) // fp.LONGEST - 1 and len(parts) > 1
        assert max(map(len, parts)) <= fp.LONGEST
        assert b"".join(parts).replace(b" ", b"") == "".join(text.split()).encode()
        new = fp.digests(fp.edited(text, "QRS TUV. " * len(text)))
        assert 0 < fp.likenesses([fp.digests(text)], [new])[0] < 0.6


def test_insertion_moves_no_cut_far_behind_it():
    rnd = random.Random(8)
    text = " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(1, 12))) for _ in range(3000))
    put = text[:9000] + "something else" + text[9000:]
    assert fp.likenesses([fp.digests(text)], [fp.digests(put)])[0] > 0.95
    assert fp.likenesses([fp.digests("a line before\n" + text)], [fp.digests(text)])[0] > 0.99


def test_a_hot_id_spans_several_ranges(spark, docs_of, conf):
    conf(shuffle__partitions="12")
    rows = [(i, f"text {i}") for i in range(60)] + [(33, f"hot text {k} of many") for k in range(60)]
    rows += [(None, f"nameless text {k}") for k in range(60)]
    docs = docs_of(random.Random(1).sample(rows, len(rows))).repartition(4)
    cuts = fp._cuts(docs.select("doc_id"), 12)
    assert cuts == sorted(cuts, key=lambda c: (c[0] is not None, c[0] or 0, c[1]))
    ties = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    placed = ties.withColumn("place", fp._range_of(cuts)).collect()
    for r in placed:
        mine = (r["doc_id"] is not None, r["doc_id"] or 0, r["tie"])
        assert r["place"] == sum((k is not None, k or 0, t) <= mine for k, t in cuts)
    for hot in (33, None):
        sizes = Counter(r["place"] for r in placed if r["doc_id"] == hot)
        assert len(sizes) >= 3 and max(sizes.values()) <= 40
    ordered = sorted(placed, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["tie"]))
    want = expected([(r["doc_id"], r["text"]) for r in ordered])
    assert sorted(got(fp.compare_versions(docs)), key=str) == sorted(want, key=str)

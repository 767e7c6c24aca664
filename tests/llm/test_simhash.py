import random

import numpy as np
import pytest
import xxhash

from astrolode.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Position -> smallest position reachable over links of 3 bits or fewer."""
    seen = [None] * len(fps)
    for i in range(len(fps)):
        if seen[i] is None:
            seen[i], stack = i, [i]
            while stack:
                a = stack.pop()
                for b in range(len(fps)):
                    if seen[b] is None and (fps[a] ^ fps[b]).bit_count() <= 3:
                        seen[b] = i
                        stack.append(b)
    return seen


def test_odd_rows(odd_docs, odd_rows):
    fps = [brute_fingerprint(t) for _, t in odd_rows]
    part = brute_components(fps)
    want = []
    for (i, _), fp, p in zip(odd_rows, fps, part, strict=True):
        ids = [odd_rows[k][0] for k in range(len(part)) if part[k] == p]
        ids = [x for x in ids if x is not None]
        want.append((i, f"{fp:016x}", min(ids) if ids else None))
    got = sorted(map(tuple, simhash.components(odd_docs).collect()), key=str)
    assert got == sorted(want, key=str)


def test_empty(no_docs):
    assert simhash.components(no_docs).collect() == []
    assert simhash.one_of_each(no_docs).collect() == []


def test_one_of_each_keeps_all_columns(odd_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    least = {r["component_id"] for r in simhash.components(odd_docs).collect()}
    assert {r["doc_id"] for r in kept.collect()} == least


def test_long_text_in_parts(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 64)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


@pytest.mark.parametrize("block", [4096, 8])
def test_every_link_is_found(spark, block):
    rnd = random.Random(block)
    fps = {rnd.getrandbits(64) for _ in range(150)}
    for fp in list(fps)[:40]:  # chains, and stars around one fingerprint
        now = fp
        for _ in range(rnd.randrange(1, 9)):
            for b in rnd.sample(range(64), rnd.randrange(1, 5)):
                now ^= 1 << b
            fps.add(now)
    center = next(iter(fps))
    for _ in range(300):
        fps.add(center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 4))))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash.links(frame, block=block)
    rows = found.collect()
    at = {x: k for k, x in enumerate(signed)}
    assert all((fps[at[r["a"]]] ^ fps[at[r["b"]]]).bit_count() <= 3 for r in rows)
    tied = {r["node"]: r["root"] for r in simhash.roots(found).collect()}
    part = brute_components(fps)
    groups = {}
    for k, x in enumerate(signed):
        groups.setdefault(part[k], set()).add(tied.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**64, 5000, np.uint64), rng.integers(0, 2**64, 5000, np.uint64)
    manhattan = np.bitwise_count(simhash.unary_of(a) ^ simhash.unary_of(b))
    by_hand = sum(
        np.abs(np.bitwise_count(a >> np.uint64(2 * i) & np.uint64(3)).astype(int)
               - np.bitwise_count(b >> np.uint64(2 * i) & np.uint64(3)).astype(int))
        for i in range(32))
    assert (manhattan == by_hand).all()
    assert (manhattan <= np.bitwise_count(a ^ b)).all()


def test_more_fingerprints_more_groups():
    assert simhash.groups_for(10**5) < simhash.groups_for(10**9) <= 12
    assert len(simhash.masks(6)) == 20

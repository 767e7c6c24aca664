import random
import re
import zlib

import numpy as np
import pytest

from astrolode.llm import runs
from astrolode.llm.queries import with_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least):
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = any(q % p == 0 and all(words[k] == words[k + p] for k in range(start, start + length - p))
                          for p in range(1, q))
            if length >= max(least.words, least.periods * q) and not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_text(rnd):
    letters, text = rnd.choice([1, 2, 2, 3, 5, 30]), []
    while len(text) < rnd.choice([0, 1, 5, 20, 60, 150]):
        part = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 9))]
        text += (part * rnd.randrange(1, 9))[:rnd.randrange(1, 60)] if rnd.random() < 0.6 else part
    return text


@pytest.mark.parametrize("least", [runs.Least(), runs.Least(2, 2), runs.Least(6, 2), runs.Least(3, 3),
                                   runs.Least(1, 4), runs.Least(9, 2)])
def test_all_runs_and_no_others(least):
    rnd = random.Random(least.words)
    for _ in range(80):
        made = [made_text(rnd) for _ in range(rnd.randrange(1, 8))]
        codes = np.array([c for t in made for c in t], np.int64)
        got = runs.find_runs(codes, np.cumsum([len(t) for t in made]), least)
        assert [tuple(r) for r in got.tolist()] == [(i, *r) for i, t in enumerate(made) for r in brute(t, least)]


def test_one_period_is_no_run():
    with pytest.raises(ValueError):
        runs.Least(6, 1)


def test_long_texts():
    codes = np.array([(i % 100) if i % 1000 else -1 for i in range(200_000)]) + 1
    got = runs.find_runs(codes, np.array([len(codes)]))
    assert len(got) == 201 and (got[:, 2] >= 4 * got[:, 3]).all()
    again = runs.find_runs(np.zeros(200_000, np.int64), np.array([200_000]))
    assert again.tolist() == [[0, 0, 200_000, 1]]
    half = "01" * 60_000
    assert runs.find_runs(np.array([*half, "2", *half], "U1").view("i4").astype(np.int64),
                          np.array([240_001])).tolist() == [[0, 0, 120_000, 2], [0, 120_001, 120_000, 2]]


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("chunk", [runs.CHUNK_BYTES, 500])
def test_documents(docs_of, odd_rows, monkeypatch, chunk):
    monkeypatch.setattr(runs, "CHUNK_BYTES", chunk)
    rnd = random.Random(4)
    rows = [*odd_rows, (900, "a b " * 9), (901, "x y\t" * 5 + "z"), (902, "a" + "\n" * 9), (903, "é " * 6)]
    rows += [(1000 + k, " ".join(f"w{c}" for c in made_text(rnd))) for k in range(60)]
    rows += [rows[-1]] * 3
    want = []
    for i, text in rows:
        words = WORD.findall(text or "")
        found = brute(words[:3000], runs.Least()) if len(words) < 3000 else []
        want.append((str(i), len(words), str(found), collapsed(words, found)))
    got = [(str(r["doc_id"]), r["n_words"], str([tuple(x) for x in r["runs"]]), r["collapsed"])
           for r in runs.collapse(docs_of(rows).repartition(3)).collect()]
    assert sorted(got) == sorted(want)
    assert sum(w[2] != "[]" for w in want) > 20


def test_empty(spark, no_docs, docs_of):
    assert runs.collapse(no_docs).collect() == []
    assert [tuple(r) for r in runs.collapse(docs_of([(1, None)])).collect()] == [(1, 0, [], "")]


def test_with_repeats(docs_of, odd_rows):
    rows = [(i, t) for i, t in odd_rows] + [(k, f"a b c d e f {k}\ng h i") for k in range(2000, 2200)]
    want = []
    for i, text in rows:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[:a] + [words[a + (k - a) % p] for k in range(a, n)])
        want.append((str(i), str(text)))
    got = [(str(r["doc_id"]), str(r["text"])) for r in with_repeats(docs_of(rows)).collect()]
    assert sorted(got) == sorted(want)
    assert len(set(want) - {(str(i), str(t)) for i, t in rows}) > 10

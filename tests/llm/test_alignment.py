import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from astrolode.llm import alignment
from astrolode.llm.bpe import byte_characters
from astrolode.llm.queries import BYTE_BPE, PIECE_BPE


class Brute:
    """Each text by the libraries alone, and all overlaps of its tokens."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_BPE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
        self.byte = {c: b for b, c in enumerate(byte_characters())}

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        of_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        of_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(of_a) != (" " + text).encode() or b"".join(of_b) != (" " + text).encode():
            return [], [], [], []
        return a, b, list(itertools.accumulate(map(len, of_a))), list(itertools.accumulate(map(len, of_b)))

    def align(self, text):
        a, b, ends_a, ends_b = self.tokens(text or "")
        cuts = sorted(set(ends_a) & set(ends_b))
        at_a, at_b = ({end: k for k, end in enumerate(ends, 1)} for ends in (ends_a, ends_b))
        last_a, last_b = [at_a[c] for c in cuts], [at_b[c] for c in cuts]
        groups = ";".join(
            ",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m]))
            for (i, j), (k, m) in zip(itertools.pairwise([0, *last_a]), itertools.pairwise([0, *last_b]), strict=True))
        links, i, k = [], 0, 0
        while i < len(a):
            links.append((a[i], b[k]))
            step_a, step_b = ends_a[i] <= ends_b[k], ends_b[k] <= ends_a[i]
            i, k = i + step_a, k + step_b
        return a, b, last_a, last_b, groups, links


@pytest.fixture(scope="module")
def brute():
    return Brute()


def odd_texts(odd_rows):
    rnd = random.Random(6)
    signs = ["a", "the", "Ünder", " ", "  ", "\n", "\t", " \n", "▁", "　", "\x85", "\xa0", "ﬁ", "日本", "🙂👍🏽",
             "<0x41>", "<s>", "<|endoftext|>", "'s", "é", "Ⅷ", "123456", "\x00", "==", "ѐ", "Ა", "\x1c"]
    texts = ["".join(rnd.choice(signs) + rnd.choice(["", " "]) for _ in range(rnd.randrange(1, 40))) for _ in range(250)]
    texts += [" ", "  ", "a ", " a", "▁", "x" * 3000, "日本語" * 500, "🙂" * 300, "a▁b c", "b ▁"]
    return [*odd_rows, *enumerate(texts, 3000)]


def check(rows, found, brute):
    aligned = [(i, brute.align(t)) for i, t in rows]
    counts = Counter(p for _, x in aligned for p in x[5])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    want = sorted((
        str(i), len(a), len(b), len(last_a), len(links), sum(counts[p] == best[p[1]] for p in links),
        sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for i, (a, b, last_a, _, groups, links) in aligned)
    assert sorted((str(r[0]), *r[1:]) for r in found) == want
    return want


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(docs_of, odd_rows, brute, small, monkeypatch):
    rows = odd_texts(odd_rows)
    if small:  # many batches and chunks, and a cache that overflows
        rows = rows[::3]
        monkeypatch.setattr(alignment, "BATCH_BYTES", 700)
        monkeypatch.setattr(alignment, "CHUNK_LINKS", 900)
        monkeypatch.setattr(alignment, "CACHED_WORDS", 5)
        monkeypatch.setattr(alignment, "ROWS", 7)
    got = alignment.statistics(docs_of(rows).repartition(3), BYTE_BPE, PIECE_BPE)
    want = check(rows, got.collect(), brute)
    assert sum(not w[1] for w in want) > 5 and sum(w[1] > 0 for w in want) > 80


def test_given_documents(spark, brute):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, alignment.statistics(docs, BYTE_BPE, PIECE_BPE).collect(), brute)


def test_align(docs_of, odd_rows, brute, no_docs):
    rows = odd_texts(odd_rows)[::2]
    want = sorted((str(i), *map(str, brute.align(t)[:4])) for i, t in rows)
    got = alignment.align(docs_of(rows).repartition(2), BYTE_BPE, PIECE_BPE).collect()
    assert sorted((str(r[0]), *map(str, r[1:])) for r in got) == want
    assert alignment.align(no_docs, BYTE_BPE, PIECE_BPE).collect() == []


def test_empty(docs_of, no_docs):
    assert alignment.statistics(no_docs, BYTE_BPE, PIECE_BPE).collect() == []
    rows = alignment.statistics(docs_of([(1, None), (2, "")]), BYTE_BPE, PIECE_BPE).collect()
    assert sorted(map(tuple, rows)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_groups_of_any_ends():
    rnd = np.random.default_rng(3)
    for size, chance in ((1, 0.5), (30, 0.05), (300, 0.5), (5000, 0.02), (5000, 0.9)):
        counts, ends = [], []
        for _ in range(2):
            flags = rnd.random((7, size)) < chance
            flags[:, -1] = True
            flags[3] = False  # a text without tokens
            counts.append(flags.sum(1))
            ends.append(np.flatnonzero(flags) + 1)
        tokens = alignment.Encoded(ends[0], ends[1], *counts, *ends)
        last_a, last_b = alignment.groups(tokens)
        shared = np.intersect1d(*ends)
        assert (ends[0][last_a] == shared).all() and (ends[1][last_b] == shared).all()
        a, b = alignment.links(tokens)
        assert len(a) == len(np.union1d(*ends)) == len(set(zip(a.tolist(), b.tolist(), strict=True)))


def test_no_shared_cut_is_one_group():
    a, b = np.arange(1, 40_001, 2), np.arange(2, 40_001, 2)
    tokens = alignment.Encoded(np.append(a, 0), b, np.array([len(a) + 1]), np.array([len(b)]),
                               np.append(a, 40_000), b)
    last_a, last_b = alignment.groups(tokens)
    assert last_a.tolist() == [len(a)] and last_b.tolist() == [len(b) - 1]


def test_words_stand_alone_with_these_files():
    both = alignment.Encoders(BYTE_BPE, PIECE_BPE)
    assert both._by_word and both._ranked
    texts = pa.array(["one two one", "one  two", "", None, "two"])
    found = both.encode(texts.fill_null(""))
    assert found.counts_a.tolist()[2:4] == [0, 0] and found.counts_a[0] == 3


def test_part_of_an_array(odd_rows, brute):
    texts = [t or "" for _, t in odd_texts(odd_rows)]
    both = alignment.Encoders(BYTE_BPE, PIECE_BPE)
    found = both.encode(pa.array([*texts, *texts]).slice(len(texts) - 10, len(texts)))
    want = [brute.tokens(t) for t in (texts[-10:] + texts[:-10])]
    assert found.a.tolist() == [x for w in want for x in w[0]]
    assert found.b.tolist() == [x for w in want for x in w[1]]
    assert found.counts_a.tolist() == [len(w[0]) for w in want]

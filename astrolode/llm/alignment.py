"""Alignment of two tokenizers' tokens of the same texts.

A is a byte-level BPE file, B a sentencepiece model. Both cut the same bytes, a space and the
text, so what tells them apart is where tokens end. The tokens of a text are cut into groups by
divide and conquer at shared cuts: an A end near the middle of an interval is looked for among
the B ends by bisection, the nearest one that is there cuts the interval in two, and both halves
go on alike; an interval without such an end is a group. All intervals of all texts of a chunk
take each step together, so that a step is a few numpy calls.

A's and B's tokens are linked where their bytes overlap. How often each pair of ids is linked in
the whole corpus is counted by Spark: a chunk sends each of its pairs once, the sums are kept in a
table that grows with the corpus, and each chunk's pairs meet their sums again.

Neither encoder looks beyond a space inside a text, so each different word of a chunk is encoded
once, and what occurs several times stays in a bounded cache. Texts for which that is not certain
(other white space beside a space, the mark that sentencepiece writes for a space) are encoded
whole. A file whose ids are the order of its merges is read as ranks, too, which is four times as
fast for words of old and stable scripts; all others go through the file's own library.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from astrolode.llm.bpe import byte_characters
from astrolode.llm.common import gathered, key_type, texts, written

CACHED_WORDS = 200_000
CACHED_LENGTH = 64
# Bytes of text that are aligned together (plus at most one text), and links of a chunk of texts
# that share the counts sent to them.
BATCH_BYTES = 2_000_000
CHUNK_LINKS = 1 << 22
ROWS = 1 << 18

# Fixed value: how byte-level files cut a text before merging.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Latin, Greek and Cyrillic, whose letters are the same in all releases of Unicode.
_STABLE = re.compile("[\\x00-\u052f]*")
_SPACE = "▁"  # how sentencepiece writes a space
_WHITE = r"[ \t-\r\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WHOLE = rf"\A | \z|{_WHITE} | {_WHITE}|{_SPACE}"
_NAMES = 1 << 16


class Encoders:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one it has
        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        count_a, count_b = self._a.get_vocab_size(), self._b.get_piece_size()
        if max(count_a, count_b) > _NAMES:
            raise ValueError("ids must be below 65,536")
        byte = {c: b for b, c in enumerate(byte_characters())}
        self.bytes_a = [self._of_a(self._a.id_to_token(i) or "", byte) for i in range(count_a)]
        self.bytes_b = [self._of_b(i) for i in range(count_b)]
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        rule = spec["pre_tokenizer"] or {}
        cut = rule.get("type") == "ByteLevel" and rule.get("use_regex") and not (
            rule.get("add_prefix_space") or spec["normalizer"])
        self._ranked = self._by_rank(spec["model"]) if cut else None
        self._by_word = bool(cut and self._words_stand_alone())
        self._known_a: dict[str, bytes] = {}
        self._known_b: dict[str, bytes] = {}

    @staticmethod
    def _of_a(token: str, byte: dict[str, int]) -> bytes:
        return bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def _of_b(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace(_SPACE, " ").encode()

    def _by_rank(self, model: dict) -> tiktoken.Encoding | None:
        """The same vocabulary as ranks, if ids are bytes first and then merges in their order."""
        ids = model["vocab"]
        merged = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        order = {a + b: 256 + i for i, (a, b) in enumerate(merged)}
        order |= {c: ids[c] for c in byte_characters() if ids.get(c, 256) < 256}
        if len(order) != 256 + len(merged) or any(ids.get(t) != i for t, i in order.items()):
            return None
        ranks = {self.bytes_a[i]: i for i in order.values()}
        return tiktoken.Encoding("a", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def _words_stand_alone(self) -> bool:
        pieces = (self._b.id_to_piece(i) for i in range(self._b.get_piece_size()))
        probe = "x  ﬁ é Ⅰ "  # changed by any of the usual normalizations
        same = b"".join(self.bytes_b[i] for i in self._b.encode(probe)) == f" {probe}".encode()
        return same and not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces)

    def _of_texts(self, some: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The 16-bit ids of texts by A and by B; none where their bytes are not those of the text."""
        of_a: list[bytes | None] = [None] * len(some)
        if self._ranked:  # gives back any bytes
            encode, stable = self._ranked.encode_ordinary, _STABLE.fullmatch
            of_a = [array("H", encode(" " + t)).tobytes() if stable(t) else None for t in some]
        wrong = {i for i, t in enumerate(some) if not t}
        late = [i for i, ids in enumerate(of_a) if ids is None]
        name = self.bytes_a.__getitem__
        by_file = self._a.encode_batch([" " + some[i] for i in late], add_special_tokens=False)
        for i, found in zip(late, by_file, strict=True):
            of_a[i] = array("H", found.ids).tobytes()
            if b"".join(map(name, found.ids)) != b" " + some[i].encode():
                wrong.add(i)
        of_b: list[bytes] = []
        name = self.bytes_b.__getitem__
        for at in range(0, len(some), 4096):  # few lists at a time
            part = some[at:at + 4096]
            for text, ids in zip(part, self._b.encode(part, num_threads=1), strict=True):
                if b"".join(map(name, ids)) != (" " + text).encode():
                    wrong.add(len(of_b))
                of_b.append(array("H", ids).tobytes())
        for i in wrong:
            of_a[i] = of_b[i] = b""
        return of_a, of_b

    def _of_words(self, words: list[str], often: list[bool]) -> tuple[list[bytes], list[bytes]]:
        """The ids of different words, from the cache or newly encoded; those met often are kept."""
        of_a, of_b = list(map(self._known_a.get, words)), list(map(self._known_b.get, words))
        gaps = [i for i, x in enumerate(of_a) if x is None]
        for i, a, b in zip(gaps, *self._of_texts([words[i] for i in gaps]), strict=True):
            of_a[i], of_b[i] = a, b
        keep = [i for i in gaps if often[i] and len(words[i]) <= CACHED_LENGTH]
        if len(self._known_a) + len(keep) > CACHED_WORDS:
            self._known_a, self._known_b = {}, {}
            keep = [i for i, x in enumerate(often) if x and len(words[i]) <= CACHED_LENGTH]
        for i in keep[:CACHED_WORDS]:
            self._known_a[words[i]], self._known_b[words[i]] = of_a[i], of_b[i]
        return of_a, of_b

    def encode(self, some: pa.Array) -> Encoded:
        """The tokens of all these texts."""
        some = some.cast(pa.large_string())
        plain = pc.and_(pc.not_equal(some, ""), pc.invert(pc.match_substring_regex(some, _WHOLE)))
        if not self._by_word:
            plain = pc.and_(plain, False)
        mask = plain.to_numpy(zero_copy_only=False)
        by_words, whole = np.flatnonzero(mask), np.flatnonzero(~mask)
        split = pc.split_pattern(some.filter(plain), " ")
        coded = split.flatten().dictionary_encode()
        places = coded.indices.to_numpy()
        often = np.bincount(places, minlength=len(coded.dictionary)) > 1
        by_word = self._of_words(coded.dictionary.to_pylist(), often.tolist())
        alone = self._of_texts(some.take(pa.array(whole)).to_pylist())
        starts = split.offsets.to_numpy()
        # A word that is not encoded right spoils the whole of its text.
        bad = np.zeros(len(some), bool)
        if not all(by_word[0]):
            spoilt = np.array([not x for x in by_word[0]])
            bad[by_words[np.searchsorted(starts, np.flatnonzero(spoilt[places]), "right") - 1]] = True
        sides = []
        for of_words, of_whole, length in zip(by_word, alone, (self.length_a, self.length_b), strict=True):
            # The words' ids one after another, taken by the place of each word.
            sizes = np.fromiter(map(len, of_words), np.int64, len(of_words)) // 2
            table = np.frombuffer(b"".join(of_words), np.uint16)
            taken = sizes[places]
            ends = np.concatenate(([0], np.cumsum(taken)))
            first = (np.cumsum(sizes) - sizes)[places] - ends[:-1]
            flat = table[np.repeat(first, taken) + np.arange(ends[-1])]
            at = ends[starts]
            counts = np.zeros(len(some), np.int64)
            counts[by_words] = np.diff(at)
            parts, done = [], 0
            for i, before, x in zip(whole, np.searchsorted(by_words, whole), of_whole, strict=True):
                own = np.frombuffer(x, np.uint16)
                parts += [flat[at[done]:at[before]], own]
                counts[i], done = len(own), before
            ids = np.concatenate([*parts, flat[at[done]:]]) if parts else flat
            if bad.any():
                ids, counts = ids[np.repeat(~bad, counts)], np.where(bad, 0, counts)
            sides.append((ids, counts, np.cumsum(length[ids])))
        (a, counts_a, ends_a), (b, counts_b, ends_b) = sides
        return Encoded(a, b, counts_a, counts_b, ends_a, ends_b)


@dataclass(frozen=True)
class Encoded:
    """The ids of texts by A and by B, one text after another, how many each text has, and the
    bytes up to the end of each token. Each text has as many bytes by A as by B."""

    a: np.ndarray
    b: np.ndarray
    counts_a: np.ndarray
    counts_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


@lru_cache(maxsize=2)
def encoders(path_a: str, path_b: str) -> Encoders:
    """One pair per Python worker: its tables and cache serve all tasks that run there."""
    return Encoders(path_a, path_b)


def _nearest_cut(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """For each interval of A tokens [low, high), one whose end is also a B end, as near to the
    middle as there is one, but not the interval's last; and that B token. -1 where there is none."""
    cut_a = np.full(len(low), -1)
    cut_b = np.full(len(low), -1)
    middle = (low + high - 2) // 2
    open_ = np.arange(len(low))
    radius, tried = 0, -1
    while len(open_):
        # All places between the radius tried before and this one, the nearest first.
        steps = np.arange(tried + 1, radius + 1)
        steps = np.column_stack((steps, -steps)).ravel()[0 if tried >= 0 else 1:]
        for some in np.array_split(open_, max(1, len(open_) * len(steps) >> 20)):
            place = middle[some, None] + steps
            place = np.where((place >= low[some, None]) & (place < high[some, None] - 1), place, -1)
            end = ends_a[place]
            other = np.searchsorted(ends_b, end.ravel()).reshape(end.shape)
            hit = (place >= 0) & (ends_b[np.minimum(other, len(ends_b) - 1)] == end)
            row, first = np.arange(len(some)), hit.argmax(1)
            found = hit[row, first]
            cut_a[some[found]] = place[row, first][found]
            cut_b[some[found]] = other[row, first][found]
        left = np.maximum(middle - low, high - 2 - middle)[open_] > radius
        open_ = open_[left & (cut_a[open_] < 0)]
        tried, radius = radius, max(1, 2 * radius)
    return cut_a, cut_b


def groups(tokens: Encoded) -> tuple[np.ndarray, np.ndarray]:
    """The last A token and the last B token of each group, in order."""
    high_a, high_b = np.cumsum(tokens.counts_a), np.cumsum(tokens.counts_b)
    some = tokens.counts_a > 0
    low_a, low_b = (high_a - tokens.counts_a)[some], (high_b - tokens.counts_b)[some]
    high_a, high_b = high_a[some], high_b[some]
    last_a, last_b = [high_a - 1], [high_b - 1]
    while len(low_a):
        wide = (high_a - low_a > 1) & (high_b - low_b > 1)
        low_a, high_a, low_b, high_b = low_a[wide], high_a[wide], low_b[wide], high_b[wide]
        cut_a, cut_b = _nearest_cut(tokens.ends_a, tokens.ends_b, low_a, high_a)
        cut = cut_a >= 0
        cut_a, cut_b = cut_a[cut], cut_b[cut]
        last_a.append(cut_a)
        last_b.append(cut_b)
        low_a, high_a = _halves(low_a[cut], cut_a + 1, high_a[cut])
        low_b, high_b = _halves(low_b[cut], cut_b + 1, high_b[cut])
    return np.sort(np.concatenate(last_a)), np.sort(np.concatenate(last_b))


def _halves(low: np.ndarray, cut: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.column_stack((low, cut)).ravel(), np.column_stack((cut, high)).ravel()


def links(tokens: Encoded) -> tuple[np.ndarray, np.ndarray]:
    """The A token and the B token of each two that share bytes: one pair per end of either."""
    ends = np.concatenate((tokens.ends_a, tokens.ends_b))
    ends.sort(kind="stable")  # merges two ordered parts
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    return np.searchsorted(tokens.ends_a, ends), np.searchsorted(tokens.ends_b, ends)


def _decimals() -> tuple[np.ndarray, np.ndarray]:
    """Each 16-bit number as decimal digits in a row of six bytes, and how many it has."""
    ids = np.arange(_NAMES)
    count = np.searchsorted(10 ** np.arange(1, 5), ids, "right") + 1
    place = count[:, None] - 1 - np.arange(6)
    digits = ids[:, None] // 10 ** np.maximum(place, 0) % 10 + ord("0")
    return digits.astype(np.uint8), count


@lru_cache(maxsize=1)
def _decimal_table() -> tuple[np.ndarray, np.ndarray]:
    return _decimals()


def written_groups(tokens: Encoded, last_a: np.ndarray, last_b: np.ndarray) -> Iterator[bytes]:
    """The groups of each text as `a1,a2|b1;a3|b2,b3`; nothing for a text without tokens."""
    digits, count = _decimal_table()
    first_a = np.concatenate(([0], last_a[:-1] + 1)) if len(last_a) else last_a
    first_b = np.concatenate(([0], last_b[:-1] + 1)) if len(last_b) else last_b
    # Each group's A tokens come before its B tokens, and after all tokens of earlier groups.
    order = np.empty(len(tokens.a) + len(tokens.b), np.uint16)
    at_a = np.arange(len(tokens.a)) + np.repeat(first_b, last_a - first_a + 1)
    at_b = np.arange(len(tokens.b)) + np.repeat(last_a + 1, last_b - first_b + 1)
    order[at_a], order[at_b] = tokens.a, tokens.b
    mark = np.full(len(order), ord(","), np.uint8)
    mark[at_a[last_a]] = ord("|")
    mark[at_b[last_b]] = ord(";")
    ends = np.concatenate(([0], np.cumsum(tokens.counts_a + tokens.counts_b)))
    for i, j in _stretches(ends):
        ids = order[ends[i]:ends[j]]
        rows, size = digits[ids], count[ids]
        rows[np.arange(len(ids)), size] = mark[ends[i]:ends[j]]
        flat = rows[np.arange(6) <= size[:, None]].tobytes()
        cuts = np.concatenate(([0], np.cumsum(size + 1)))[ends[i:j + 1] - ends[i]].tolist()
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield flat[start:max(start, end - 1)]


def _stretches(ends: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Numbers of texts [i, j) that have about so many tokens together."""
    i = 0
    while i < len(ends) - 1:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + size, "right")) - 1)
        yield i, j
        i = j


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """`doc_id`, `a_ids` and `b_ids` of each text, and `a_ends` and `b_ends`: how many tokens of
    each come up to the end of each group.

    A null or empty text, and one whose bytes do not come back from both, has none of either.
    Repeated rows have a result each, an empty table gives an empty one, extra columns are left
    out, and documents do not move.
    """
    names = ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"]

    def run(batches):
        both = encoders(path_a, path_b)
        for batch in gathered(batches, BATCH_BYTES):
            tokens = both.encode(batch["text"])
            columns = []
            for ids, counts in ((tokens.a, tokens.counts_a), (tokens.b, tokens.counts_b)):
                columns.append(_lists(ids.astype(np.int32), np.cumsum(counts)))
            for last, counts in zip(groups(tokens), (tokens.counts_a, tokens.counts_b), strict=True):
                high = np.cumsum(counts)
                cuts = np.searchsorted(last, high)  # groups before the end of each text
                own = (last + 1 - np.repeat(high - counts, np.diff(cuts, prepend=0))).astype(np.int32)
                columns.append(_lists(own, cuts))
            yield pa.record_batch([batch["doc_id"], *columns], names)

    return texts(docs).mapInArrow(run, f"doc_id {key_type(docs)}, " + ", ".join(
        f"{n} array<int>" for n in names[1:]))


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(values))


def _aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A written row per document: its `chunk`, sums, `groups_sha256`, the different `pairs` of ids
    it links (A's in the high 16 bits) and how many `times` each."""
    sums = ["n_a", "n_b", "n_groups", "n_links"]
    names = ["doc_id", "chunk", *sums, "groups_sha256", "pairs", "times"]
    per_chunk = CHUNK_LINKS

    def run(batches):
        both = encoders(path_a, path_b)
        chunk, size = TaskContext.get().partitionId() << 40, 0
        for batch in gathered(batches, BATCH_BYTES):
            tokens = both.encode(batch["text"])
            last_a, last_b = groups(tokens)
            a, b = links(tokens)
            high = np.cumsum(tokens.counts_a)
            text = np.searchsorted(high, a, "right")
            keys, times = np.unique(
                text << 32 | tokens.a[a].astype(np.int64) << 16 | tokens.b[b], return_counts=True)
            cuts = np.searchsorted(keys, np.arange(len(high) + 1) << 32).tolist()
            pairs, times = keys.astype(np.uint32), times.astype(np.uint32)
            digests = [hashlib.sha256(g).hexdigest() if g else ""
                       for g in written_groups(tokens, last_a, last_b)]
            yield pa.record_batch([
                batch["doc_id"], pa.array(np.full(len(high), chunk)),
                *(pa.array(x.astype(np.int64)) for x in (
                    tokens.counts_a, tokens.counts_b,
                    np.diff(np.searchsorted(last_a, high), prepend=0),
                    np.bincount(text, minlength=len(high)))),
                pa.array(digests, pa.string()),
                *(pa.array([x[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary())
                  for x in (pairs, times))], names)
            size += len(a)
            if size >= per_chunk:
                chunk, size = chunk + 1, 0

    return written(texts(docs).mapInArrow(
        run, f"doc_id {key_type(docs)}, chunk long, " + ", ".join(f"{c} long" for c in sums)
             + ", groups_sha256 string, pairs binary, times binary"), "aligned")


def _numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4")


def _per_chunk(aligned: DataFrame) -> DataFrame:
    """`chunk`, `pair`, `times`: the sums of each chunk, written."""
    def added_up(chunk, held):
        keys, times = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order].astype(np.int64)
        first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ 1))
        sums = np.add.reduceat(times, first) if len(first) else times
        for at in range(0, len(first), ROWS):
            part = first[at:at + ROWS]
            yield pa.record_batch([
                pa.array(np.full(len(part), chunk)), pa.array(keys[part].view(np.int32)),
                pa.array(sums[at:at + ROWS])], ["chunk", "pair", "times"])

    def run(batches):
        # Rows of a chunk follow each other; one read in two parts only sends some pairs twice.
        held, size, now = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            chunks = batch["chunk"].to_numpy()
            starts = np.flatnonzero(np.diff(chunks, prepend=-1)).tolist()
            for i, j in zip(starts, [*starts[1:], len(chunks)], strict=True):
                if held and (chunks[i] != now or size >= CHUNK_LINKS):
                    yield from added_up(now, held)
                    held, size = [], 0
                now = chunks[i]
                held.append((_numbers(batch["pairs"].slice(i, j - i)), _numbers(batch["times"].slice(i, j - i))))
                size += len(held[-1][0])
        if held:
            yield from added_up(now, held)

    return written(aligned.select("chunk", "pairs", "times").mapInArrow(
        run, "chunk long, pair int, times long"), "pairs")


def pair_counts(per_chunk: DataFrame) -> DataFrame:
    """`pair`, its `count` in the corpus, and whether it is the `best` of its B id; written."""
    counted = per_chunk.groupBy("pair").agg(F.sum("times").alias("count"))
    # A B id has no more rows than A has ids.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(_NAMES - 1))
    return written(counted.withColumn("best", F.col("count") == F.max("count").over(of_b)), "counts")


def statistics(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """`doc_id`, the numbers of tokens, groups and links, of links whose pair of ids is its B id's
    most frequent (`n_best`), the sum of the links' counts in the corpus, and the SHA-256 of the
    groups (see `written_groups`; an empty string for texts without tokens, see `align`)."""
    aligned = _aligned(docs, path_a, path_b)
    per_chunk = _per_chunk(aligned)
    known = per_chunk.join(pair_counts(per_chunk), "pair").select("chunk", "pair", "count", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        pair = found["pair"].to_numpy().view(np.uint32)
        order = np.argsort(pair)
        own = _numbers(rows["pairs"])
        times = _numbers(rows["times"]).astype(np.int64)
        at = order[np.searchsorted(pair, own, sorter=order)] if len(own) else np.empty(0, np.int64)
        sizes = pc.binary_length(rows["pairs"]).to_numpy() // 4
        ends = np.concatenate(([0], np.cumsum(sizes)))
        sums = []
        for name in ("best", "count"):
            value = found[name].to_numpy().astype(np.int64)
            running = np.concatenate(([0], np.cumsum(value[at] * times)))
            sums.append(pa.array(np.diff(running[ends])))
        return pa.table([*(rows[n] for n in names[:5]), *sums, rows["groups_sha256"]], names)

    return aligned.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        run, f"doc_id {key_type(docs)}, " + ", ".join(f"{n} long" for n in names[1:-1])
             + ", groups_sha256 string")

"""Periodic runs of words, by a Kruskal walk down the LCP values of a text's suffixes.

A run is a stretch of words with smallest period q that no neighbouring word extends, of `Least`
length at least. The suffixes of a text are sorted by prefix doubling, and neighbours in that
order are joined by an edge that weighs as many words as they have in common (their LCP). Edges
are taken from the heaviest down. Each unites two classes of suffixes, kept in a union-find whose
roots hold the class's positions in order; the smaller class goes into the larger. When positions
i < j become neighbours in a class at LCP l, the text from i to j + l has period j - i; if that
is long enough and no word to the left goes on with it, it is a run.

Every run is found, once, with its exact end: for its start s and period q, s and s + q have the
LCP length - q >= q. Were there a third position of the class between them, the run would have
a smaller period as well. So they are neighbours from the moment they are united, and what weighs
less than the shortest run of any period leaves over needs no uniting.

Spark deals out the documents; a task works on chunks of some megabytes of text and at least one
document. A text none of whose stretches of so many words occurs twice has no run and stops there.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from astrolode.llm.common import gathered, key_type, texts

CHUNK_BYTES = 4_000_000
_BETWEEN_WORDS = "[\\x20\\x09-\\x0D]+"
# The high bits of a number are the text, the low ones a hash of some words.
_HASH_BITS = 40


@dataclass(frozen=True)
class Least:
    """The shortest run of period q has max(`words`, `periods` * q) words; two periods at least."""

    words: int = 6
    periods: int = 4

    def __post_init__(self):
        if self.periods < 2:
            raise ValueError("a run has two periods at least")

    @property
    def common(self) -> int:
        """The least LCP of a run's start and the place one period on, whatever the period."""
        return min(max(self.words - q, (self.periods - 1) * q) for q in range(1, self.words + 2))


def _suspects(codes: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """The texts (by number) in which some stretch of `size` words may occur twice; never too few."""
    starts = np.concatenate(([0], ends[:-1]))
    count = len(codes) - size + 1
    if count <= 0:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        hashes = np.zeros(count, np.uint64)
        for k in range(size):
            hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + mixed[k:k + count]
    text = np.repeat(np.arange(len(ends)), ends - starts)
    inside = text[:count] == text[size - 1:]
    keys = hashes[inside] >> np.uint64(64 - _HASH_BITS)
    keys |= text[:count][inside].astype(np.uint64) << np.uint64(_HASH_BITS)
    keys.sort()
    return np.unique(keys[1:][keys[1:] == keys[:-1]] >> np.uint64(_HASH_BITS)).astype(np.int64)


class Suffixes:
    """The sorted suffixes of texts that lie one after another, each up to its text's end.

    `ranks[t]` names the 2^t words from each place: the same number for the same words of the
    same text. The last entry, behind all texts, is 0.
    """

    def __init__(self, codes: np.ndarray, ends: np.ndarray):
        n = len(codes)
        lengths = np.diff(ends, prepend=0)
        text = np.repeat(np.arange(len(ends)), lengths)
        end = np.repeat(ends, lengths)
        rank = np.zeros(n + 1, np.int64)
        everywhere = np.arange(n)
        rank[:n], active = self._refined(text * (int(codes.max(initial=0)) + 1) + codes, everywhere,
                                         np.ones(n, np.int64))
        self.ranks = [rank.astype(np.int32)]
        reach = 1
        while len(active):
            ahead = active + reach
            after = np.where(ahead < end[active], rank[np.minimum(ahead, n)], 0)
            rank[active], active = self._refined(rank[active] * (n + 2) + after, active, rank[active])
            self.ranks.append(rank.astype(np.int32))
            reach *= 2
        self.order = np.empty(n, np.int64)
        self.order[rank[:n] - 1] = everywhere

    @staticmethod
    def _refined(keys: np.ndarray, places: np.ndarray, first: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """New ranks of `places` by `keys`, and the places whose key others have as well.

        `first` is the least rank of the class a place was in; keys keep these classes in order.
        """
        order = np.argsort(keys, kind="stable")
        ordered, old = keys[order], first[order]
        index = np.arange(len(keys))
        new = np.ones(len(keys), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        other = np.ones(len(keys), bool)
        other[1:] = old[1:] != old[:-1]
        group = np.maximum.accumulate(np.where(new, index, 0))
        parent = np.maximum.accumulate(np.where(other, index, 0))
        ranks = np.empty(len(keys), np.int64)
        ranks[order] = old + group - parent
        last = np.append(new[1:], True)
        return ranks, np.sort(places[order[~(new & last)]])

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words the suffixes at these different places have in common (their LCP)."""
        found = np.zeros(len(left), np.int64)
        for t in reversed(range(len(self.ranks))):
            rank = self.ranks[t]
            found += (rank[left + found] == rank[right + found]).astype(np.int64) << t
        return found

    def edges(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Where in the order a suffix has `least` words or more in common with the one before it,
        and how many; the most first."""
        t = min(least.bit_length(), len(self.ranks)) - 1
        name = self.ranks[t][self.order]
        at = np.flatnonzero(name[1:] == name[:-1]) + 1
        weight = self.common(self.order[at - 1], self.order[at])
        at, weight = at[weight >= least], weight[weight >= least]
        order = np.argsort(-weight, kind="stable")
        return at[order], weight[order]


def _kruskal(suffixes: Suffixes, least: Least) -> Iterator[tuple[int, int, int]]:
    """`place`, length and period of each run."""
    at, weight = suffixes.edges(least.common)
    word = suffixes.ranks[0].tolist()
    # Only suffixes with an edge take part: their places in the order, packed together.
    taking_part = np.unique(np.concatenate((at - 1, at)))
    right = np.searchsorted(taking_part, at).tolist()
    left = np.searchsorted(taking_part, at - 1).tolist()
    classes = [[p] for p in suffixes.order[taking_part].tolist()]
    root = list(range(len(classes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b, common in zip(left, right, weight.tolist(), strict=True):
        a, b = find(a), find(b)
        if len(classes[a]) > len(classes[b]):
            a, b = b, a
        few, many = classes[a], classes[b]
        furthest = common // (least.periods - 1)
        cuts = [bisect_left(many, p) for p in few]
        last = len(few) - 1
        for k, (p, cut) in enumerate(zip(few, cuts, strict=True)):
            # A neighbour on either side, unless the next of the few is nearer.
            if cut and (not k or cuts[k - 1] != cut):
                q = many[cut - 1]
                period = p - q
                if period <= furthest and common + period >= least.words and word[q - 1] != word[p - 1]:
                    yield q, common + period, period
            if cut < len(many) and (k == last or cuts[k + 1] != cut):
                q = many[cut]
                period = q - p
                if period <= furthest and common + period >= least.words and word[p - 1] != word[q - 1]:
                    yield p, common + period, period
        if len(few) == 1:
            many.insert(cuts[0], few[0])
        else:
            many += few
            many.sort()  # two ordered parts are only merged
        root[a] = b
        classes[a] = None


def find_runs(codes: np.ndarray, ends: np.ndarray, least: Least = Least()) -> np.ndarray:
    """Rows of text number, start, length and period, in that order, for texts of word codes that
    lie one after another and end where `ends` says."""
    lengths = np.diff(ends, prepend=0)
    some = _suspects(codes, ends, least.common)
    if not len(some):
        return np.empty((0, 4), np.int64)
    places = np.repeat((ends - lengths)[some] - np.cumsum(lengths[some]) + lengths[some], lengths[some])
    cut = np.cumsum(lengths[some])
    found = np.array([*_kruskal(Suffixes(codes[places + np.arange(cut[-1])], cut), least)],
                     np.int64).reshape(-1, 3)
    text = np.searchsorted(cut, found[:, 0], "right")
    start = found[:, 0] - (cut - lengths[some])[text]
    rows = np.column_stack((some[text], start, found[:, 1], found[:, 2]))
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _collapsed(words: pa.Array, runs: np.ndarray) -> str:
    """The words without those that a run holds after its first period."""
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
    np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
    return " ".join(words.filter(pa.array(np.cumsum(inside[:-1]) == 0)).to_pylist())


def collapse(docs: DataFrame, least: Least = Least()) -> DataFrame:
    """`doc_id`, `n_words`, `runs` (structs of start, length and period, ordered by start, then
    period; words are numbered from 0) and the `collapsed` text of each document.

    Words are what white space (space and U+0009 to U+000D) separates. The collapsed text has one
    space between the words that stay. A null or empty text has no words, no runs and collapses
    to nothing. Repeated rows have a result each, an empty table gives an empty one, and extra
    columns are left out. Documents do not move.
    """
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def run(batches):
        for batch in gathered(batches, CHUNK_BYTES):
            plain = pc.utf8_trim(pc.replace_substring_regex(
                batch["text"].cast(pa.large_string()), pattern=_BETWEEN_WORDS, replacement=" "), " ")
            split = pc.split_pattern(plain, " ")
            words = split.flatten()
            empty = pc.equal(plain, "").to_numpy(zero_copy_only=False)
            # An empty text is split into one empty word, which is a word of no other text.
            lengths = np.diff(split.offsets.to_numpy())
            if empty.any():
                words = words.filter(pc.not_equal(words, ""))
                lengths = np.where(empty, 0, lengths)
            ends = np.cumsum(lengths)
            coded = words.dictionary_encode()
            found = find_runs(coded.indices.to_numpy().astype(np.int64), ends, least)
            cuts = np.searchsorted(found[:, 0], np.arange(len(ends) + 1))
            collapsed = {
                i: _collapsed(words.slice(ends[i] - lengths[i], lengths[i]), found[cuts[i]:cuts[i + 1], 1:])
                for i in np.unique(found[:, 0]).tolist()}
            if collapsed:
                kept = plain.to_pylist()
                for i, text in collapsed.items():
                    kept[i] = text
                plain = pa.array(kept, pa.large_string())
            runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(found[:, k]) for k in (1, 2, 3)], ["start", "length", "period"]))
            yield pa.record_batch(
                [batch["doc_id"], pa.array(lengths, pa.int64()), runs, plain.cast(pa.string())], names)

    return texts(docs).mapInArrow(
        run, f"doc_id {key_type(docs)}, n_words long, "
             "runs array<struct<start: long, length: long, period: long>>, collapsed string")

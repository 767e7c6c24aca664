"""BPE encoding and decoding with a tokenizer file, by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round finds, in every word, the pair of
neighbours that was learnt first (binary search over the sorted pair keys gives its rank),
merges all its occurrences and looks up again only the pairs next to a merge. Words in which
nothing is left to merge leave the array. Because every merge of the file is learnt after the
merges that make its two parts, merging all occurrences of a word's best pair at once gives
what one merge at a time gives; `Vocabulary` refuses a file for which this does not hold.

Encoding is that of a lower-casing word-level BPE file (NFC, lower case, white space dropped,
words closed by a suffix, bytes shown as characters). Words never cross white space, so a text
is cut there and each different word is encoded once per task while it stays in a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from astrolode.llm.common import gathered, key_type, texts

CACHED_WORDS = 400_000
CACHED_LENGTH = 64
CHUNK_CHARS = 4_000_000
_NONE = np.int32(2**31 - 1)

# str.split() also cuts at these four control characters; the tokenizer takes them as symbols.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WORDS_WITH_SEPARATORS = re.compile("(?:[^\\s]|[\x1c-\x1f])+")

# Up to here (Latin, Greek, Cyrillic) all releases of Unicode agree, so Python's tables can be
# used; words with later code points go through the rules of the tokenizer file itself.
_LAST_STABLE = 0x52F


# Their lower-case and composed forms lie below this one.
_LAST_FORM = 0x2FFF


def _members(category: str) -> str:
    """The code points of a general category (its first letter) that such words can hold."""
    return "".join(f"\\u{c:04x}" for c in range(_LAST_FORM + 1)
                   if unicodedata.category(chr(c))[0] == category)


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, others from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    for b in range(256):
        shown.setdefault(b, chr(0x100 + len(shown) - len(plain)))
    return [shown[b] for b in range(256)]


class Vocabulary:
    """The tables of one tokenizer file and the encoder over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids, merges = model["vocab"], model["merges"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not suffix or max(ids.values()) >= 1 << 16:
            raise ValueError("a BPE file with a word suffix and ids below 65,536 is needed")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._marks = tuple(self.special)
        names = {**{i: w for w, i in ids.items()}, **{i: w for w, i in self.special.items()}}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        shown = byte_characters()
        self._inner = np.array([ids[c] for c in shown], np.int64)
        self._last = np.array([ids[c + suffix] for c in shown], np.int64)
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        self._merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self._check_order(left, right)
        keys = (left << 16) | right
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], order.astype(np.int32)
        # The pairs of single bytes, where every word begins, are looked up once for all.
        a, b = np.divmod(np.arange(1 << 16), 256)
        self._inner_pairs = self._rank(self._inner[a], self._inner[b])
        self._last_pairs = self._rank(self._inner[a], self._last[b])
        letters, numbers = _members("L"), _members("N")
        self._split = re.compile(
            f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]"
            f"|(?:[^\\s{letters}{numbers}]|[\x1c-\x1f])+"
        )
        self._unstable = re.compile(f"[^\\x00-\\u{_LAST_STABLE:04x}]")
        self._shown = {c: b for b, c in enumerate(shown)}
        self._path = path
        # No word at all, and the special tokens.
        self._fixed = {"": b""} | {
            mark: int(i).to_bytes(4, "little") for mark, i in self.special.items()}
        self._cache: dict[str, bytes] = dict(self._fixed)

    def _check_order(self, left, right) -> None:
        made = np.full(1 << 16, -1, np.int64)
        made[self._merged] = np.arange(len(self._merged))
        place = np.arange(len(self._merged))
        if len(np.unique(self._merged)) != len(place) or (made[left] >= place).any() or (
                made[right] >= place).any():
            raise ValueError("the file's merges are not in the order they were learnt")

    def _rank(self, left, right):
        key = (left << 16) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NONE)

    def merge_words(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and how many each has; `raw` are their bytes, `ends` their ends."""
        names = np.arange(len(ends))
        starts = np.concatenate(([0], ends[:-1]))
        symbols = self._inner[raw]
        symbols[ends - 1] = self._last[raw[ends - 1]]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # rank[i] is that of the pair (i, i + 1), none at the end of a word.
        rank = np.full(len(symbols), _NONE, np.int32)
        pairs = (raw[:-1].astype(np.int64) << 8) | raw[1:]
        rank[:-1] = self._inner_pairs[pairs]
        closing = (ends - 2)[np.diff(ends, prepend=0) > 1]
        rank[closing] = self._last_pairs[pairs[closing]]
        rank[ends - 1] = _NONE
        while len(names):
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            if (best == _NONE).any():
                ended = best == _NONE
                keep = np.repeat(~ended, lengths)
                done.append((names[ended], lengths[ended], symbols[~keep]))
                symbols, rank = symbols[keep], rank[keep]
                names, best, lengths = names[~ended], best[~ended], lengths[~ended]
                starts = np.cumsum(lengths) - lengths
                if not len(names):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, lengths))
            # Overlapping occurrences (a a a) are merged from the left: every second one of a run.
            first = np.ones(len(hit), bool)
            first[1:] = np.diff(hit) != 1
            run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbols[hit] = self._merged[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            gone = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(~keep, out=gone[1:])
            starts = starts - gone[starts]
            at = hit - gone[hit]
            symbols, rank = symbols[keep], rank[keep]
            self._rerank(symbols, rank, at, starts)
        return self._in_order(done)

    @staticmethod
    def _in_order(done) -> tuple[np.ndarray, np.ndarray]:
        """The finished words, put back into their first order."""
        if not done:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        names, lengths, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(names)
        starts = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        offset = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        return symbols[np.arange(len(symbols)) + offset].astype("<u4"), lengths

    def _rerank(self, symbols, rank, at, starts) -> None:
        """Look up the pairs on both sides of the merged symbols at `at`."""
        is_start = np.zeros(len(symbols) + 1, bool)
        is_start[starts] = True
        is_start[len(symbols)] = True
        rank[at] = _NONE
        after = at[~is_start[at + 1]]
        rank[after] = self._rank(symbols[after], symbols[after + 1])
        before = at[~is_start[at]] - 1
        rank[before] = self._rank(symbols[before], symbols[before + 1])

    def _pieces(self, words: list[str]) -> list[str]:
        """What BPE takes one by one, of raw words without white space; a line feed ends each."""
        joined = unicodedata.normalize("NFC", "\n".join(words) + "\n")
        # Character by character: str.lower() treats a sigma at the end of a word differently.
        joined = "".join(c.lower() for c in joined) if "\u03a3" in joined else joined.lower()
        return self._split.findall(joined)

    @cached_property
    def _file(self) -> Tokenizer:
        return Tokenizer.from_file(self._path)

    def _pieces_by_file(self, word: str) -> list[str]:
        parts = self._file.pre_tokenizer.pre_tokenize_str(self._file.normalizer.normalize_str(word))
        return [*(bytes(self._shown[c] for c in part).decode() for part, _ in parts), "\n"]

    def _learn(self, words: list[str]) -> list[bytes]:
        """The ids of raw words, as little-endian 32-bit bytes, in no more than one pass over them."""
        order = None
        plain, other = words, []
        if self._unstable.search("\n".join(words)):
            by_file = [self._unstable.search(w) is not None for w in words]
            order = np.argsort(by_file, kind="stable")
            plain = [w for w, late in zip(words, by_file, strict=True) if not late]
            other = [w for w, late in zip(words, by_file, strict=True) if late]
        pieces = self._pieces(plain) if plain else []
        for w in other:
            pieces += self._pieces_by_file(w)
        # Neither pieces nor words hold spaces or line feeds: these separate them here.
        raw = np.frombuffer(" ".join(pieces).encode() + b" ", np.uint8)
        space, line = raw == 32, raw == 10
        last = np.zeros(len(raw), bool)
        last[:-1] = space[1:] & ~line[:-1]
        inside = ~(space | line)
        ids, lengths = self.merge_words(raw[inside], np.cumsum(inside)[last])
        words_before = np.cumsum(line)[last]
        total = np.bincount(words_before, weights=lengths, minlength=len(words))
        cuts = np.concatenate(([0], np.cumsum(total).astype(np.int64) * 4)).tolist()
        flat = ids.tobytes()
        found = [flat[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        if order is None:
            return found
        back = [b""] * len(words)
        for at, got in zip(order.tolist(), found, strict=True):
            back[at] = got
        return back

    def encode_batch(self, batch: Sequence[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        held, chars = [], 0
        for text in batch:
            held.append(text)
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from self._encode(held)
                held, chars = [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield from self._encode(held)
            pa.default_memory_pool().release_unused()

    def _odd(self, text: str) -> list[str] | None:
        """The words of a text that white space alone does not cut rightly, else None."""
        parts = self._specials.split(text) if any(m in text for m in self._marks) else [text]
        if len(parts) == 1 and not _SEPARATORS.search(text):
            return None
        return [w for p in parts
                for w in ([p] if p in self.special else _WORDS_WITH_SEPARATORS.findall(p))]

    def _encode(self, held: list[str]) -> Iterator[bytes]:
        """Each different word of the texts is looked up once; Arrow cuts, counts and puts together."""
        odd = {i: ws for i, text in enumerate(held) if (ws := self._odd(text)) is not None}
        plain = [None if i in odd else text for i, text in enumerate(held)]
        words = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        found = pa.array(self._look_up(coded.dictionary.to_pylist()), pa.large_binary())
        ids = found.take(coded.indices)
        flat = ids.buffers()[2] if len(ids) else None
        ends = _offsets(ids)[words.offsets.to_numpy()].tolist()
        for i, (start, end) in enumerate(zip(ends, ends[1:], strict=False)):
            if i in odd:
                different = list(dict.fromkeys(odd[i]))
                known = dict(zip(different, self._look_up(different), strict=True))
                yield b"".join(map(known.__getitem__, odd[i]))
            else:
                yield flat[start:end].to_pybytes() if end > start else b""

    def _look_up(self, words: list[str]) -> list[bytes]:
        """The ids of different words, from the cache or newly encoded."""
        cache = self._cache
        ids = list(map(cache.get, words))
        gaps = [i for i, x in enumerate(ids) if x is None]
        if not gaps:
            return ids
        missing = [words[i] for i in gaps]
        learnt = self._learn(missing)
        for i, got in zip(gaps, learnt, strict=True):
            ids[i] = got
        if len(cache) > CACHED_WORDS:  # what is frequent is in this chunk, too
            self._cache = cache = self._fixed | {
                w: x for w, x in zip(words, ids, strict=True) if w in cache}
        cache.update(zip(missing, learnt, strict=True))
        for w in [w for w in missing if len(w) > CACHED_LENGTH]:
            del cache[w]
        return ids

    def decode(self, ids: bytes) -> bytes:
        """The text of ids (as `encode_batch` gives them), in UTF-8.

        The file has no decoder, so tokens stand as they are in the vocabulary, a space between.
        """
        names = self.names
        return b" ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _offsets(array: pa.Array) -> np.ndarray:
    """Where the values of a large binary array begin and end."""
    if not len(array):
        return np.zeros(1, np.int64)
    return np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker: its tables and cache serve all tasks that run there."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id` and `ids` (little-endian unsigned 32-bit) of every whole text.

    A null text counts as empty and gives no ids. Rows are never moved: repeated rows give
    repeated results, an empty table an empty one, and extra columns are left out.
    """
    def run(batches):
        vocab = vocabulary(path)
        for batch in gathered(batches, CHUNK_CHARS):
            ids = pa.array(vocab.encode_batch(batch["text"].to_pylist()), pa.binary())
            yield pa.record_batch([batch["doc_id"], ids], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, f"doc_id {key_type(docs)}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id` and `text` from a frame of `doc_id` and `ids`; null ids count as none."""
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            back = [vocab.decode(i or b"").decode() for i in batch["ids"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], pa.array(back, pa.string())], ["doc_id", "text"])

    frame = encoded.select("doc_id", "ids")
    return frame.mapInArrow(run, f"doc_id {key_type(encoded)}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `n_tokens`, and the SHA-256 of the ids and of the text decoded from them.

    Encodes and decodes in one pass, so that neither ids nor decoded texts leave the task.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        vocab = vocabulary(path)
        for batch in gathered(batches, CHUNK_CHARS):
            counts, of_ids, of_text = [], [], []
            for ids in vocab.encode_batch(batch["text"].to_pylist()):
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(vocab.decode(ids)).hexdigest())
            yield pa.record_batch([
                batch["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                pa.array(of_text, pa.string())], names)

    return texts(docs).mapInArrow(
        run, f"doc_id {key_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string")

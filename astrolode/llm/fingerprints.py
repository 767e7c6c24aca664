"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: its lines, and long lines further where the text itself says so
(by a rolling hash of the last characters), so that an insertion moves no cut far behind it; where
it says nothing for `LONGEST` bytes, a paragraph ends there, be it within a word. Each different
paragraph, counted by its occurrence, goes into a few cells of a sketch; a cell holds how many
went in, the XOR of their digests and the XOR of a check of each. Two sketches of one size
subtract cell by cell: what both texts share cancels out, and peeling the rest gives the digests
that only one of them has. If peeling gets stuck, both sketches are made larger and tried again.

The likeness of two texts is the share of common paragraphs among all of both (0 to 1).
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from astrolode.llm.common import key_type, partitions, texts

# Of a fingerprint; a retry takes twice as many.
CELLS = 8
HASHES = 3
# Bytes of a paragraph within a line (its last one can be shorter). Between the two, one in 2 ** CUT_BITS
# positions ends it.
SHORTEST = 16
LONGEST = 48
CUT_BITS = 5
# Texts that are worked on together, by their number of characters.
CHUNK_CHARS = 2_000_000

_U = np.uint64
_CELL = np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")])


def _cuts_within(whole: bytes) -> list[int]:
    """Positions behind which a paragraph may end, by a hash of the 8 bytes before them."""
    if len(whole) < 8:
        return []
    windows = np.ndarray(len(whole) - 7, "<u8", whole, strides=(1,))
    hashes = (windows ^ (windows >> _U(29))) * _U(0x9E3779B97F4A7C15)
    return (np.flatnonzero(hashes >> _U(64 - CUT_BITS) == 0) + 8).tolist()


def paragraphs(text: str) -> list[bytes]:
    """The paragraphs of a text; words and lines, not the white space between, make them."""
    lines = [x for x in (b" ".join(line.split()) for line in text.encode().split(b"\n")) if x]
    whole = b"\n".join(lines)
    # Windows that reach into the line before end within SHORTEST bytes of a line: none counts.
    cuts, k = [*_cuts_within(whole), len(whole) + LONGEST], 0
    found, at = [], 0
    for line in lines:
        end = at + len(line)
        while end - at > SHORTEST:
            while cuts[k] < at + SHORTEST:
                k += 1
            cut = min(cuts[k], at + LONGEST)
            if cut >= end:
                break
            found.append(whole[at:cut])
            at = cut
        found.append(whole[at:end])
        at = end + 1
    return found


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys ^ _U(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _check(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 99) >> _U(32)).astype(np.uint32)


def digests(text: str) -> np.ndarray:
    """A different 64-bit digest per paragraph; a repeated one differs by its number."""
    parts = paragraphs(text)
    keys = np.fromiter(map(xxh64_intdigest, parts, repeat(6)), _U, len(parts))
    keys.sort()
    first = np.searchsorted(keys, keys)  # equal ones now stand together
    number = (np.arange(len(keys)) - first).astype(_U)
    return np.unique(_mix(keys ^ _mix(number, 7), 8))


def sketches(sets: Sequence[np.ndarray], cells: int) -> np.ndarray:
    """One sketch per set of digests: an array (set, hash function, cell)."""
    shape = (len(sets), HASHES, cells)
    made = np.zeros(shape, _CELL)
    keys = np.concatenate([np.empty(0, _U), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    key, check = np.zeros(shape, _U).ravel(), np.zeros(shape, np.uint32).ravel()
    count = np.zeros(key.shape, np.int64)
    for k in range(HASHES):
        at = _places(owner, keys, k, cells)
        count += np.bincount(at, minlength=len(count))
        np.bitwise_xor.at(key, at, keys)
        np.bitwise_xor.at(check, at, _check(keys))
    made["count"], made["key"] = count.reshape(shape), key.reshape(shape)
    made["check"] = check.reshape(shape)
    return made


def _places(owner: np.ndarray, keys: np.ndarray, k: int, cells: int) -> np.ndarray:
    return (owner * HASHES + k) * cells + (_mix(keys, k) % _U(cells)).astype(np.int64)


@dataclass(frozen=True)
class Difference:
    """Digests on one side only: which pair they belong to and on which side (+1, -1) they are."""

    pair: np.ndarray
    key: np.ndarray
    side: np.ndarray
    whole: np.ndarray  # per pair: nothing is missing


def subtract(a: np.ndarray, b: np.ndarray) -> Difference:
    """Subtract sketches pair by pair and peel what is left, all pairs round by round."""
    pairs, _, cells = a.shape
    count = (a["count"].astype(np.int64) - b["count"]).ravel()
    key, check = (a["key"] ^ b["key"]).ravel(), (a["check"] ^ b["check"]).ravel()
    freed = np.zeros(pairs, np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while True:
        pure = np.flatnonzero(np.abs(count) == 1)
        pure = pure[_check(key[pure]) == check[pure]]
        pair = pure // (HASHES * cells)
        # A cell that only looks pure could lead in circles: no pair frees more than its cells.
        going = freed[pair] < HASHES * cells
        pure, pair = pure[going], pair[going]
        if not len(pure):
            break
        order = np.lexsort((key[pure], pair))  # a digest can stand alone in several cells
        pure, pair = pure[order], pair[order]
        new = np.ones(len(pure), bool)
        new[1:] = (key[pure][1:] != key[pure][:-1]) | (pair[1:] != pair[:-1])
        pure, pair = pure[new], pair[new]
        keys, side = key[pure], count[pure]
        out.append((pair, keys, side))
        freed += np.bincount(pair, minlength=pairs)
        for k in range(HASHES):
            at = _places(pair, keys, k, cells)
            np.subtract.at(count, at, side)
            np.bitwise_xor.at(key, at, keys)
            np.bitwise_xor.at(check, at, _check(keys))
    left = (count != 0) | (key != 0) | (check != 0)
    whole = ~left.reshape(pairs, -1).any(axis=1)
    none = (np.empty(0, np.int64), np.empty(0, _U), np.empty(0, np.int64))
    pair, keys, side = (np.concatenate(x) for x in zip(none, *out, strict=True))
    return Difference(pair, keys, side, whole)


def differences(a: Sequence[np.ndarray], b: Sequence[np.ndarray], cells: int = CELLS
                ) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pair of sets the digests of `a` only and of `b` only; where peeling fails, both sketches
    are made twice as large and tried again."""
    done: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, _U), np.empty(0, _U))] * len(a)
    open_ = np.arange(len(a))
    while len(open_):
        # Sizes that cannot hold the difference in the numbers of digests are passed over.
        able = np.array([abs(len(a[i]) - len(b[i])) <= HASHES * cells for i in open_])
        tried = open_[able]
        # So many pairs at once that their sketches stay small in memory.
        stuck = []
        for part in np.array_split(tried, max(1, len(tried) * cells // 50_000)):
            if not len(part):
                continue
            apart = subtract(sketches([a[i] for i in part], cells),
                             sketches([b[i] for i in part], cells))
            ends = np.searchsorted(apart.pair[order := np.argsort(apart.pair, kind="stable")],
                                   np.arange(len(part) + 1))
            keys, side = apart.key[order], apart.side[order]
            for n, i in enumerate(part):
                if apart.whole[n]:
                    mine = slice(ends[n], ends[n + 1])
                    done[i] = keys[mine][side[mine] > 0], keys[mine][side[mine] < 0]
                else:
                    stuck.append(i)
        open_ = np.array([*open_[~able], *stuck], np.int64)
        cells *= 2
    return done


def likenesses(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> list[float]:
    """Per pair, common paragraphs among all of both; two texts without any are alike."""
    out = []
    for x, (only_x, only_y) in zip(a, differences(a, b), strict=True):
        common, everything = len(x) - len(only_x), len(x) + len(only_y)
        out.append(common / everything if everything else 1.0)
    return out


def written_out(items: int, sketch: np.ndarray) -> str:
    """A sketch as text: its number of digests, its size, its cells."""
    return f"{items:x}:{sketch.shape[1]:x}:{base64.b64encode(sketch.tobytes()).decode()}"


def read_in(text: str) -> tuple[int, np.ndarray]:
    items, cells, raw = text.split(":")
    flat = np.frombuffer(base64.b64decode(raw), _CELL)
    return int(items, 16), flat.reshape(HASHES, int(cells, 16))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
          "near_next"]


def _columns(now: list[str], after: list[str]) -> list[pa.Array]:
    """All fields but the id for texts and the texts that follow them."""
    changed = [edited(a, b) for a, b in zip(now, after, strict=True)]
    # A text and the one that follows it are mostly neighbours in the list: digest each once.
    known: dict[str, np.ndarray] = {}
    for text in (*now, *after, *changed):
        if text not in known:
            known[text] = digests(text)
    sets = [[known[t] for t in part] for part in (now, after, changed)]
    prints = [
        [written_out(len(s), made) for s, made in zip(part, sketches(part, CELLS), strict=True)]
        for part in (sets[0], sets[2])
    ]
    return [
        pa.array([len(t) for t in now], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array(prints[0], pa.string()), pa.array(prints[1], pa.string()),
        pa.array(likenesses(sets[0], sets[2]), pa.float64()),
        pa.array(likenesses(sets[0], sets[1]), pa.float64()),
    ]


def _neighbours(batches):
    """Chunks (ids, texts, the texts that follow) from sorted rows of one or more ranges."""
    keys, now, after, chars = [], [], [], 0
    before = None  # place, id, text
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        columns = (batch[c] for c in ("place", "extra", "doc_id", "text"))
        for place, extra, key, text in zip(*(c.to_pylist() for c in columns), strict=True):
            if before and before[0] == place:
                keys.append(before[1])
                now.append(before[2])
                after.append(text)
                chars += len(before[2]) + len(text)
            before = None if extra else (place, key, text)
            if chars >= CHUNK_CHARS:
                yield pa.array(keys, kind), now, after
                keys, now, after, chars = [], [], [], 0
    if keys:
        yield pa.array(keys, kind), now, after


# Ties, the hashes of texts, are spread evenly over the 64-bit numbers from this one on.
LOWEST = -2**63


def _cuts(rows: DataFrame, count: int) -> list[tuple]:
    """(id, tie) pairs that cut the rows into about as many ranges, in order; None is before all ids.

    An id, or none, that fills several ranges is cut between its ties, evenly.
    """
    if count < 2:
        return []
    shares = [i / count for i in range(1, count)]
    got = rows.agg(
        F.percentile_approx("doc_id", shares, 20 * count).alias("cuts"),
        F.count("doc_id").alias("named"), F.count(F.lit(1)).alias("rows")).first()
    spans = Counter(got["cuts"] or [])
    # Rows without an id come first; their share of the ranges is their share of the rows.
    nameless = count * (got["rows"] - got["named"]) // max(got["rows"], 1)
    cuts = [(None, LOWEST + (1 << 64) * i // nameless) for i in range(1, nameless)]
    for key in sorted(spans):
        cuts += [(key, LOWEST + (1 << 64) * i // spans[key]) for i in range(spans[key])]
    return cuts


def _range_of(cuts: list[tuple]) -> Column:
    """The number of cuts at or below the columns `doc_id` and `tie`."""
    if not cuts:
        return F.lit(0)
    keys = np.array([key for key, _ in cuts if key is not None])
    nameless = len(cuts) - len(keys)
    ties = {}
    for key, tie in cuts:
        ties.setdefault(key, []).append(tie)
    ties = {key: np.array(held, np.int64) for key, held in ties.items()}
    several = np.array([key for key, held in ties.items() if key is not None and len(held) > 1],
                       keys.dtype)

    @F.arrow_udf("int")
    def place(ids: pa.Array, tie: pa.Array) -> pa.Array:
        tie = tie.to_numpy(zero_copy_only=False)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        at = np.zeros(len(ids), np.int64)
        if None in ties:
            at[~known] = np.searchsorted(ties[None], tie[~known], "right")
        named = ids.drop_null().to_numpy(zero_copy_only=False)
        found = nameless + np.searchsorted(keys, named, "right")
        own = tie[known]
        hot = np.flatnonzero(np.isin(named, several))
        for key in np.unique(named[hot]):
            rows = hot[named[hot] == key]
            found[rows] = (nameless + np.searchsorted(keys, key, "left")
                           + np.searchsorted(ties[key.item()], own[rows], "right"))
        at[known] = found
        return pa.array(at, pa.int32())

    return place("doc_id", "tie")


def compare_versions(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of its text and its edited text, and how near these and the
    next document (ascending doc_id; after the last the first) are.

    A null text counts as empty. Rows without a doc_id come first; rows that share one follow
    each other by their texts' hash. Texts without a paragraph are alike (1) to each other and
    unlike (0) any other. With one row the next document is itself; an empty table gives an
    empty result; extra columns are left out.

    Each range of doc_ids is sorted in one task, which reads it as a stream; a doc_id that fills
    several ranges is cut between its texts' hashes. A range also gets the first row of the next
    range with rows, so texts move once and no task holds a range. How to cut is decided from the
    ids alone, and texts are only read for it if an id is cut; what reaches the driver is one id
    per range.
    """
    spark = docs.sparkSession
    cuts = _cuts(docs.select("doc_id"), partitions(spark))
    # Without an id to cut, ranges need no ties.
    cut_ties = any(tie != LOWEST for _, tie in cuts)
    by_text = F.xxhash64("text")
    rows = texts(docs).withColumn("tie", by_text if cut_ties else F.lit(LOWEST).cast("long"))
    ids = rows.select("doc_id", "tie", _range_of(cuts).alias("place"))
    found = ids.groupBy("place").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "tie")).alias("low")
    ).collect()
    # The first row of a range is also read by the range before it, that of the first by the last.
    found = sorted((r["place"], r["low"]["doc_id"], r["low"]["tie"]) for r in found)
    heads = spark.createDataFrame(
        [(at, key, tie, found[i - 1][0]) for i, (at, key, tie) in enumerate(found)],
        f"head_place int, head_id {key_type(docs)}, head_tie long, reader int")
    is_head = ((F.col("place") == F.col("head_place")) & (F.col("tie") == F.col("head_tie"))
               & F.col("doc_id").eqNullSafe(F.col("head_id")))
    # One row per range: no more than there are shuffle partitions.
    marked = rows.withColumn("place", _range_of(cuts)).join(F.broadcast(heads), is_head, "left")
    once = F.array(F.struct("place", F.lit(False).alias("extra")))
    twice = F.array(F.struct("place", F.lit(False).alias("extra")),
                    F.struct(F.col("reader").alias("place"), F.lit(True).alias("extra")))
    spread = marked.select("doc_id", "text", by_text.alias("tie"), F.inline(
        F.when(F.col("reader").isNull(), once).otherwise(twice)))
    ranges = spread.repartitionById(len(cuts) + 1, F.col("place")).sortWithinPartitions(
        "place", "extra", "doc_id", "tie")
    kind = key_type(docs)

    def run(batches):
        for ids, now, after in _neighbours(batches):
            yield pa.record_batch([ids, *_columns(now, after)], FIELDS)

    return ranges.select("place", "extra", "doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")

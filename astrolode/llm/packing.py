"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only lengths matter for packing, and there are at most `capacity` different ones. So the plan
is made on a histogram: whole classes of equal pieces are placed at once, and the plan is a list
of runs ("the pieces of this length with ranks a to b go to sequences c, c+1, ... at this
offset"), whose number depends on the capacity and not on the number of pieces. Spark cuts the
documents, counts the lengths, ranks equal lengths without gaps and looks up each piece's run.

Reduction: a set {j, p} that dominates every other set with j can be fixed without loss, as any
packing can be changed to hold it. It dominates if
  * p fills what j leaves exactly: whatever else stands beside j fits in p's place;
  * only one more piece fits beside j: p is the largest of these;
  * only two fit, and the largest single one is no smaller than the best two together.
A piece beside which nothing fits is alone. What is left goes best-fit, longest first.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from astrolode.llm.bpe import CHUNK_CHARS, vocabulary
from astrolode.llm.common import gathered, key_type, numbered, texts, with_row, written

PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]
CAPACITY = 4096
END = 1

# length, first rank, pieces, first sequence, offset
Run = tuple[int, int, int, int, int]


class _Plan:
    def __init__(self, histogram: dict[int, int], capacity: int):
        self.left = dict(sorted(histogram.items()))
        self.used = dict.fromkeys(self.left, 0)
        self.capacity = capacity
        self.sequences = 0
        self.runs: list[Run] = []

    def open(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append((length, self.used[length], count, sequence, offset))
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def fix(self, lengths: list[int], count: int) -> None:
        """`count` closed sequences, each with these lengths."""
        first, offset = self.open(count), 0
        for length in lengths:
            self.put(length, count, first, offset)
            offset += length


def _best_pair(lengths: list[int], left: dict[int, int], room: int) -> int:
    """The largest sum, at most `room`, of two pieces."""
    best, low, high = 0, 0, len(lengths) - 1
    while low <= high:
        total = lengths[low] + lengths[high]
        if total > room:
            high -= 1
        else:
            if low != high or left[lengths[low]] > 1:
                best = max(best, total)
            low += 1
    return best


def _reduce(plan: _Plan) -> None:
    """Fix dominating sets until none is left to find, longest pieces first."""
    again = True
    while again:
        again = False
        for length in sorted(plan.left, reverse=True):
            while length in plan.left:
                partner = _dominating(plan, length)
                if partner is None:
                    break
                again = True
                if partner == 0:
                    plan.fix([length], plan.left[length])
                elif partner == length:
                    if plan.left[length] < 2:
                        break
                    plan.fix([length, length], plan.left[length] // 2)
                else:
                    plan.fix([length, partner], min(plan.left[length], plan.left[partner]))


def _dominating(plan: _Plan, length: int) -> int | None:
    """The partner of a set that dominates all sets with `length`; 0: alone; None: no such set."""
    room = plan.capacity - length
    others = dict(plan.left)
    others[length] -= 1
    if not others[length]:
        del others[length]
    lengths = list(others)
    at = bisect_right(lengths, room)
    if at == 0:
        return 0
    partner = lengths[at - 1]
    if partner == room:
        return partner
    fit, total = 0, 0
    for small in lengths:  # the most pieces that fit: the smallest ones
        take = min(others[small], (room - total) // small, 3 - fit)
        fit, total = fit + take, total + take * small
        if take < others[small] or fit >= 3:
            break
    if fit == 1 or fit == 2 and partner >= _best_pair(lengths[:at], others, room):
        return partner
    return None


def _best_fit(plan: _Plan) -> None:
    """Longest pieces first, each into the open sequence with the least room that holds it."""
    rooms: list[int] = []  # sorted
    open_at: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, count)

    def leave(room: int, sequence: int, count: int) -> None:
        if room not in open_at:
            rooms.insert(bisect_right(rooms, room), room)
            open_at[room] = []
        open_at[room].append((sequence, count))

    for length in sorted(plan.left, reverse=True):
        while length in plan.left:
            at = bisect_right(rooms, length - 1)
            if at == len(rooms):  # none holds it: as many new ones as these pieces fill
                per = plan.capacity // length
                count = plan.left[length]
                whole, rest = divmod(count, per)
                for pieces, sequences in ((per, whole), (rest, 1)):
                    if pieces and sequences:
                        first = plan.open(sequences)
                        for k in range(pieces):
                            plan.put(length, sequences, first, k * length)
                        leave(plan.capacity - pieces * length, first, sequences)
                break
            room = rooms[at]
            sequence, count = open_at[room].pop()
            if not open_at[room]:
                del open_at[room], rooms[at]
            # A sequence takes equal pieces as long as it has room, as best-fit would go on.
            per = min(room // length, plan.left[length])
            taken = min(count, plan.left[length] // per)
            for k in range(per):
                plan.put(length, taken, sequence, plan.capacity - room + k * length)
            leave(room - per * length, sequence, taken)
            if taken < count:
                leave(room, sequence + taken, count - taken)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place all pieces of the histogram (length: how many) into sequences."""
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    made = _Plan({length: n for length, n in histogram.items() if n}, capacity)
    _reduce(made)
    _best_fit(made)
    return made.runs


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut only if longer than `capacity`."""
    close = int(end).to_bytes(4, "little")

    def run(batches):
        vocab = vocabulary(path)
        for batch in gathered(batches, CHUNK_CHARS):
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(vocab.encode_batch(batch["text"].to_pylist())):
                ids += close
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    held = ids[at:at + 4 * capacity]
                    rows.append(row)
                    numbers.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(held) // 4)
                    sums.append(zlib.crc32(held))
            yield pa.record_batch([
                batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64())], PIECE)

    return texts(docs).mapInArrow(
        run, f"doc_id {key_type(docs)}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Every piece of every document with its `sequence_id` and `offset` there.

    A null text counts as empty: one piece with the end id alone. Repeated rows and null
    doc_ids are packed like others; an empty table gives an empty result; extra columns are
    left out. Pieces of equal length are interchangeable, so ties do not matter.
    """
    pieces = written(with_row(cut(docs, path, capacity, end)), "pieces")
    rows = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    runs = np.array(plan({r["length"]: r["count"] for r in rows}, capacity), np.int64)
    runs = runs.reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    starts = (runs[:, 0] << 44) | runs[:, 1]

    def run(batches):
        for batch in batches:
            rank = batch["rank"].to_numpy(zero_copy_only=False)
            wanted = (batch["length"].to_numpy(zero_copy_only=False) << 44) | rank
            at = np.searchsorted(starts, wanted, "right") - 1
            yield pa.record_batch([
                *(batch[c] for c in PIECE), pa.array(runs[at, 3] + rank - runs[at, 1]),
                pa.array(runs[at, 4])], [*PIECE, "sequence_id", "offset"])

    ranked = numbered(pieces, "length", "rank")
    return ranked.select(*PIECE, "rank").mapInArrow(
        run, f"doc_id {key_type(docs)}, piece int, start long, length long, ids_crc32 long, "
             "sequence_id long, offset long")

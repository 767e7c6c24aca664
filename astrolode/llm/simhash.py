"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

A fingerprint is cut into segments of two bits; the bits set in each make a point with 32
coordinates from 0 to 2. One differing bit moves one coordinate by at most one, so the Manhattan
distance of two points is never more than the Hamming distance of their fingerprints. Points
within distance 3 differ in at most 3 of g groups of coordinates, so they share a grid cell in
one of the C(g, 3) projections that leave 3 groups out. Points that share a cell are compared:
first by Manhattan distance, then exactly. g is chosen by the number of fingerprints.

Only different fingerprints are compared, and a cell gives the edges of a spanning forest of its
links, never all its pairs. A cell beyond `BLOCK` members is cut into blocks that are compared
two at a time, each pair of blocks in a task of its own, so every link is found at any size.

Coordinates are held in unary (0, 01, 11), two bits each: then the Manhattan distance is a count
of differing bits, and a projection is a mask.
"""

from __future__ import annotations

import math
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from astrolode.llm.common import key_type, texts, written

SHINGLE = 3
SEED = 42
BITS = 3
SEGMENTS = 32
GROUPS = range(5, 13)
BLOCK = 4096
SHINGLES_AT_ONCE = 1 << 15

_LOW = 0x5555555555555555


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text; zero without words."""
    words = text.encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, count, SHINGLES_AT_ONCE):
        part = words[at:at + SHINGLES_AT_ONCE + shingle - 1]
        if len(words) < shingle:
            grams = [b" ".join(words)]
        else:
            grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False))
        hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id` and `fp`, the fingerprint as a signed 64-bit number."""
    def run(batches):
        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.record_batch([batch["doc_id"], pa.array(made.view(np.int64))], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, f"doc_id {key_type(docs)}, fp long")


def unary(fp: Column) -> Column:
    """The embedding: each segment's number of set bits, in unary."""
    shifted, low = F.shiftrightunsigned(fp, 1), F.lit(_LOW)
    either = fp.bitwiseOR(shifted).bitwiseAND(low)
    both = fp.bitwiseAND(shifted).bitwiseAND(low)
    return either.bitwiseOR(F.shiftleft(both, 1))


def unary_of(fp: np.ndarray) -> np.ndarray:
    low, one = np.uint64(_LOW), np.uint64(1)
    return ((fp | fp >> one) & low) | (fp & fp >> one & low) << one


def groups_for(count: int, bits: int = BITS) -> int:
    """The number of groups with the least work expected: rows sent and points compared by chance.

    Two random segments have equal counts with a probability of 3/8.
    """
    def work(g: int) -> float:
        projections = math.comb(g, bits)
        by_chance = count * count / 2 * 0.375 ** (SEGMENTS * (g - bits) / g)
        return projections * (count + by_chance / 16)

    return min((g for g in GROUPS if g > bits), key=work)


def masks(groups: int, bits: int = BITS) -> list[int]:
    """Per projection, the unary bits of the coordinates it keeps, as a signed number."""
    cuts = [round(i * SEGMENTS / groups) for i in range(groups + 1)]
    whole = [((1 << 2 * b) - (1 << 2 * a)) for a, b in zip(cuts, cuts[1:], strict=False)]
    kept = [sum(c) for c in combinations(whole, groups - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def _near(fps, points, fp, point, bits):
    """Which of the fingerprints link: Manhattan distance first, then the exact one."""
    may = np.flatnonzero(np.bitwise_count(points ^ point) <= bits)
    return may[np.bitwise_count(fps[may] ^ fp) <= bits]


def forest(fps: np.ndarray, side: np.ndarray | None, bits: int) -> list[tuple[int, int]]:
    """Edges that join all linked fingerprints of a cell: a search that drops what it has found.

    With `side` only links between the two sides are followed.
    """
    points, edges = unary_of(fps), []
    open_ = np.arange(len(fps))
    while len(open_):
        start, open_ = open_[0], open_[1:]
        waiting = [start]
        while waiting and len(open_):
            at = waiting.pop()
            rest = open_ if side is None else open_[side[open_] != side[at]]
            found = rest[_near(fps[rest], points[rest], fps[at], points[at], bits)]
            if len(found):
                edges += [(fps[at], fps[f]) for f in found]
                open_ = np.setdiff1d(open_, found, assume_unique=True)
                waiting += found.tolist()
    return edges


def _cells(batches):
    """Whole cells from a stream of batches sorted by cell: (fps, sides) each, small ones together."""
    names = ("mask", "cell", "low", "high")
    held: list[list[np.ndarray]] = []
    for batch in batches:
        got = [batch[c].to_numpy(zero_copy_only=False) for c in (*names, "side", "fp")]
        held.append(got)
        last = [c[-1] for c in got[:4]]
        if all(c[0] == x for c, x in zip(held[0][:4], last, strict=True)):
            continue  # a cell goes on from batch to batch; it has two blocks at most
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        same = np.logical_and.reduce([c == x for c, x in zip(columns[:4], last, strict=True)])
        cut = int(np.flatnonzero(~same)[-1]) + 1
        yield [c[:cut] for c in columns]
        held = [[c[cut:] for c in columns]]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _links(bits: int):
    def run(batches):
        for *names, side, fp in _cells(b for b in batches if b.num_rows):
            fp = fp.view(np.uint64)
            change = np.logical_or.reduce([c[1:] != c[:-1] for c in names])
            starts = np.concatenate(([0], np.flatnonzero(change) + 1))
            sizes = np.diff(np.append(starts, len(fp)))
            edges: list[tuple[int, int]] = []
            pair = starts[(sizes == 2) & (names[2][starts] == names[3][starts])]
            a, b = fp[pair], fp[pair + 1]
            near = np.bitwise_count(unary_of(a) ^ unary_of(b)) <= bits
            near[near] = np.bitwise_count(a[near] ^ b[near]) <= bits
            edges += zip(a[near], b[near], strict=True)
            for start, size, low, high in zip(
                    starts, sizes, names[2][starts], names[3][starts], strict=True):
                if size > 2 or low != high:
                    part = slice(start, start + size)
                    edges += forest(fp[part], side[part] if low != high else None, bits)
            made = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.record_batch([pa.array(made.min(axis=1) if len(made) else made[:, 0]),
                                   pa.array(made.max(axis=1) if len(made) else made[:, 1])],
                                  ["a", "b"])

    return run


def links(fps: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between different fingerprints `fp` that join all that are linked."""
    point = unary(F.col("fp"))
    kept = masks(groups_for(fps.count(), bits), bits)
    # Projections have no cell in common, so the cell carries the number of its projection.
    spread = fps.select("fp", F.posexplode(
        F.array(*(point.bitwiseAND(F.lit(m)) for m in kept))).alias("mask", "cell"))
    counted = spread.groupBy("mask", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("side")
    met = (
        spread.join(counted, ["mask", "cell"])
        .select("mask", "cell", "fp", blocks.alias("blocks"))
        .select("mask", "cell", "fp", "blocks", own)
        .select("mask", "cell", "fp", "side",
                F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("mask", "cell", F.least("side", "other").alias("low"),
                F.greatest("side", "other").alias("high"), "side", "fp")
    )
    place = ["mask", "cell", "low", "high"]
    sorted_ = met.repartition(*place).sortWithinPartitions(*place, "fp")
    return sorted_.mapInArrow(_links(bits), "a long, b long").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node of its component, for every node with an edge.

    Large stars and small stars in turn: each node's neighbours are tied to its smallest one,
    until nothing changes. Every round is a written table.
    """
    now = written(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                  .filter("node <> root").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("sum")).first()
        if before == state:
            return now
        before = state
        both = now.unionByName(now.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("low"))
        least = least.select("node", F.least("node", "low").alias("low"))
        large = (
            both.filter("root > node").join(least, "node")
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .filter("node <> root").distinct()
        )
        large = written(large, "large")
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node")
        small = small.select(F.col("root").alias("node"), F.col("low").alias("root")).unionByName(
            low.select("node", F.col("low").alias("root"))).filter("node <> root").distinct()
        now = written(small, "small")


def components(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id`, the smallest doc_id reachable.

    A null text counts as empty; texts without words have the fingerprint zero and link like
    others. Repeated rows and equal fingerprints are in one component. A component without any
    doc_id has a null component_id. An empty table gives an empty result; extra columns are
    left out.
    """
    made = written(fingerprints(docs, shingle), "fingerprints")
    different = written(made.groupBy("fp").agg(F.min("doc_id").alias("low")), "different")
    found = roots(links(different.select("fp"), bits))
    tied = different.join(found, different["fp"] == found["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    # One row per fingerprint: a component's smallest id, and who belongs to it.
    least = tied.groupBy("root").agg(F.min("low").alias("component_id"))
    of_fp = tied.join(least, "root").select("fp", "component_id")
    return made.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The documents with the smallest doc_id of their component; all columns stay.

    Rows that share a doc_id are one document: they stay if one of them has the smallest id of
    its component. A component without any doc_id keeps its rows, as none can be named.
    """
    found = components(docs, shingle, bits)
    stays = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # The rows that go are looked up, as they are mostly far fewer than those that stay.
    go = found.groupBy("doc_id").agg(stays.alias("stays")).filter(~F.col("stays")).select("doc_id")
    go = written(go, "go")
    return docs.join(go, docs["doc_id"].eqNullSafe(go["doc_id"]), "left_anti")

"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A row descends from the root. At every node each child draws a number from the row's key and
the child's name, -ln(u) / weight, and the smallest draw wins; a child's weight is the sum of
the weights below it. So a child is chosen in proportion to its weight, and when weights
change, rows move only into or out of the subtrees whose weights changed: between two children
whose weights stay, no row changes place.

The law is `key`: a row's shard follows from its key and the number of shards alone. A shard
that is added opens a region of its own, so the only new draw is that region's at the root, and
the rows it wins go to the new shard only.

DataFrame functions only. The descent is a row-wise expression; no row moves for it.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astrolode.llm.common import numbered, texts, with_row, written

SHARDS_PER_RACK = 2
RACKS_PER_REGION = 3
SETTLED = 24
ROW_BYTES = 8


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


def topology(shards: int) -> list[Shard]:
    """Full regions for up to `SETTLED` shards; each further shard is a region of its own.

    Below `SETTLED`, shards beyond the last full region also have regions of their own.
    """
    per_region = SHARDS_PER_RACK * RACKS_PER_REGION
    full = min(shards, SETTLED) // per_region * per_region
    placed = [Shard(i, f"r{i // per_region}", f"k{i // SHARDS_PER_RACK}") for i in range(full)]
    return placed + [Shard(i, f"own{i}", f"own{i}") for i in range(full, shards)]


def _draw(key: Column, name: str, weight: float) -> Column:
    """-ln(u) / weight with u from 53 bits of a hash, never 0 or 1."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def _winner(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """What belongs to the child with the smallest draw; ties go to the first."""
    if len(children) == 1:
        return children[0][2]
    draws = [
        F.struct(_draw(key, name, weight).alias("draw"), F.lit(i).alias("child"))
        for i, (name, weight, _) in enumerate(children)
    ]
    # Drawn once, as a one-element array, however many children refer to it.
    drawn = F.array(F.array_min(F.array(*draws))["child"])

    def follow(winner: Column) -> Column:
        chosen = F.when(winner == 0, children[0][2])
        for i, (_, _, below) in enumerate(children[1:], 1):
            chosen = chosen.when(winner == i, below)
        return chosen

    return F.transform(drawn, follow)[0]


def shard_of(key: Column, shards: list[Shard]) -> Column:
    """The number of the shard that `key` (taken as text; null is a key like others) falls to."""
    tree: dict[str, dict[str, list[Shard]]] = defaultdict(lambda: defaultdict(list))
    for shard in shards:
        if shard.weight > 0:
            tree[shard.region][shard.rack].append(shard)
    text = key.cast("string")

    def weigh(members: list[Shard]) -> float:
        return sum(s.weight for s in members)

    regions = []
    for region, racks in tree.items():
        below = [
            (f"{region}/{rack}", weigh(members), _winner(text, [
                (f"{region}/{rack}/{s.number}", s.weight, F.lit(s.number)) for s in members
            ]))
            for rack, members in racks.items()
        ]
        regions.append((region, sum(w for _, w, _ in below), _winner(text, below)))
    if not regions:
        raise ValueError("no shard has a positive weight")
    return _winner(text, regions)


def shard(docs: DataFrame, shards: int = SETTLED) -> DataFrame:
    """Every row's shard, its place there, and its shard if there were one more.

    A null text has no bytes (its size is 8, its CRC 0); rows with a null doc_id share one key
    and so one shard. Repeated rows each have a slot. Groups of equal texts are not kept
    together, as only the doc_id decides. An empty table gives an empty result. Extra columns
    are left out.
    """
    key = F.col("doc_id")
    placed = texts(docs).select(
        "doc_id",
        (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, topology(shards)).alias("shard"),
        shard_of(key, topology(shards + 1)).alias("grown_shard"),
    )
    rows = numbered(written(with_row(placed), "shards"), "shard", "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

"""Exact de-duplication against immutable snapshots, screened by binary-fuse filters.

A batch of documents is first grouped by itself, on digest and normalised text; copies are
combined before the shuffle, so a text with a third of the rows leaves each task as one row.
The groups are written as a snapshot: exact buckets (digest, text, who stays, how many) and, per
range of digests, one static filter. The representatives of the next batch are screened by the
filters of their digest range; only positives meet the exact buckets, where bytes decide.

Nothing grows in one task: a filter covers at most about `FILTER_KEYS` different digests, and
equal digests count once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astrolode.llm.binary_fuse import BinaryFuse
from astrolode.llm.common import key_type, texts, with_row, written

FILTER_KEYS = 1 << 18
BATCHES = 2

# A group of equal texts: `digest` addresses it, `tag` tells apart texts that share a digest.
_GROUP = ["digest", "tag"]


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digest_of(norm: Column) -> Column:
    return F.sha2(F.encode(norm, "UTF-8"), 256)


def fingerprinted(docs: DataFrame, digest=digest_of) -> DataFrame:
    norm = texts(docs).select("doc_id", normalised(F.col("text")).alias("norm"))
    return norm.select(
        "doc_id", "norm", digest(F.col("norm")).alias("digest"), F.xxhash64("norm").alias("tag"),
        # Only decides which batch a row belongs to here; real batches come as they arrive.
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(BATCHES)).alias("batch"),
    )


def group_batch(batch: DataFrame) -> DataFrame:
    """The batch's different texts: bytes decide, copies are combined before the shuffle."""
    return batch.groupBy("digest", "tag", "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _range_of(digest: Column, ranges: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(ranges)).cast("int")


def _key_of(digest: Column) -> Column:
    """64 bits for the filter, drawn apart from the bits that choose the range."""
    return F.xxhash64(digest, F.lit("filter"))


def filters(groups: DataFrame, ranges: int) -> DataFrame:
    """One binary-fuse filter per range of digests."""
    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        made = BinaryFuse.build(pdf["key"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame([{"range": pdf["range"].iloc[0], "seed": made.seed,
                              "length": made.length, "segments": made.segments,
                              "cells": made.cells}])

    keys = groups.select(_range_of(F.col("digest"), ranges).alias("range"),
                         _key_of(F.col("digest")).alias("key")).distinct()
    return keys.groupBy("range").applyInPandas(
        build, "range int, seed int, length int, segments int, cells binary")


def screen(digests: DataFrame, snapshot_filters: DataFrame, ranges: int) -> DataFrame:
    """The digests that may be in the snapshot; each range meets its filter in one task."""
    def probe(keys: pd.DataFrame, filter_: pd.DataFrame) -> pd.DataFrame:
        if not len(filter_) or not len(keys):
            return keys[["digest"]].iloc[:0]
        f = filter_.iloc[0]
        made = BinaryFuse(int(f["seed"]), int(f["length"]), int(f["segments"]), f["cells"])
        return keys.loc[made.holds(keys["key"].to_numpy(np.int64).view(np.uint64)), ["digest"]]

    keys = digests.select("digest").distinct().select(
        "digest", _range_of(F.col("digest"), ranges).alias("range"),
        _key_of(F.col("digest")).alias("key"))
    return keys.groupBy("range").cogroup(snapshot_filters.groupBy("range")).applyInPandas(
        probe, f"digest {key_type(digests, 'digest')}")


def same_bytes(positives: DataFrame, incoming: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Groups of the incoming batch and of the snapshot that hold the same text, byte by byte.

    The digests meet first, without texts; only groups they name bring theirs. `joint_old` says
    which side holds the row that stays: the snapshot if it has the smallest doc_id, too.
    """
    met = snapshot.select("digest", "tag").join(positives, "digest", "left_semi")
    met = written(met.select("tag").distinct(), "met")
    new = incoming.join(met, "tag", "left_semi").alias("new")
    old = snapshot.join(met, "tag", "left_semi").alias("old")
    equal = (F.col("new.digest") == F.col("old.digest")) & (F.col("new.norm") == F.col("old.norm"))
    least = F.least("new.keep_id", "old.keep_id")
    return new.join(old, equal).select(
        "new.digest", "new.tag", least.alias("joint_keep"),
        (F.col("new.group_size") + F.col("old.group_size")).alias("joint_size"),
        F.col("old.keep_id").eqNullSafe(least).alias("joint_old"),
    )


def dedup(docs: DataFrame, digest=digest_of) -> DataFrame:
    """Per row: who of its equal texts stays (the smallest doc_id), how many they are.

    Half of the rows, by a hash of doc_id, are the snapshot, the others arrive as a new batch. A
    null text counts as empty, and all empty texts are equal. Rows without a doc_id are counted,
    but one stays only if no equal text has an id (`keep_id` is then null). Exactly one row of
    equal texts is kept, also where its doc_id or the whole row is repeated. An empty table gives
    an empty result; extra columns are left out.
    """
    return _dedup(fingerprinted(docs, digest)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def _dedup(rows: DataFrame) -> DataFrame:
    side = F.col("batch") == 0
    addresses = written(with_row(rows.drop("norm").withColumn("old", side)), "addresses")
    snapshot = written(group_batch(rows.filter("batch = 0")), "snapshot")
    incoming = written(group_batch(rows.filter("batch <> 0")), "incoming")
    ranges = max(1, math.ceil(snapshot.count() / FILTER_KEYS))
    positives = screen(incoming, filters(snapshot, ranges), ranges)
    joint = written(same_bytes(positives, incoming, snapshot), "joint")
    # Only settles which of several rows with the smallest doc_id stays, if its side is to hold it.
    first = addresses.groupBy(*_GROUP, "old").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("first"))
    group = (
        snapshot.select(*_GROUP, "keep_id", "group_size", F.lit(True).alias("old"))
        .unionByName(incoming.select(*_GROUP, "keep_id", "group_size", F.lit(False).alias("old")))
        .join(joint, _GROUP, "left").join(first, [*_GROUP, "old"])
        .select(*_GROUP, "old", "first", F.coalesce("joint_keep", "keep_id").alias("keep_id"),
                F.coalesce("joint_size", "group_size").alias("group_size"),
                F.coalesce(F.col("joint_old") == F.col("old"), F.lit(True)).alias("holds"))
    )
    stays = F.col("holds") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return addresses.join(group, [*_GROUP, "old"]).withColumn(
        "kept", stays & (F.col("_row") == F.col("first")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts; all columns stay as they are.

    The rows that go are looked up, as they are mostly far fewer than those that stay.
    """
    rows = written(_dedup(fingerprinted(docs)).select("doc_id", "digest", "kept"), "decided")
    if rows.groupBy("doc_id").count().filter("count > 1").isEmpty():
        go = written(rows.filter(~F.col("kept")).select("doc_id"), "go")
        return docs.join(go, docs["doc_id"].eqNullSafe(go["doc_id"]), "left_anti")
    # A repeated doc_id does not name a row: its text does, and of equal rows one stays.
    stay = rows.filter("kept").select("doc_id", "digest")
    digest = digest_of(normalised(F.coalesce(docs["text"], F.lit(""))))
    same = docs["doc_id"].eqNullSafe(stay["doc_id"]) & (digest == stay["digest"])
    name = "_" * (1 + max(map(len, docs.columns)))
    return (
        docs.join(stay, same, "left_semi")
        .withColumn(name, digest_of(normalised(F.coalesce("text", F.lit("")))))
        .dropDuplicates(["doc_id", name]).drop(name)
    )

"""Language-model scoring by cross-entropy difference.

Two bigram models, one of target text and one of the whole corpus as background, are matched:
the same vocabulary (the tokens of a public tokenizer file, whose size is fixed), the same order
and smoothing. A document's score is the mean over its tokens of the background's loss minus the
target's: above zero it reads more like the target than like the corpus at large.

Counts come from every token of every document and are exact: each pair of tokens is counted by
itself, in a table that grows with the corpus and stays in Spark. Documents are worked on in
chunks of about `CHUNK_TOKENS` tokens. A chunk sends each of its different pairs once, with its
own counts; where the chunks' rows of a pair meet they are added up, and the sums go back to the
chunks that asked. Only the counts of single tokens, as many as the vocabulary has, are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from astrolode.llm.bpe import CHUNK_CHARS, vocabulary
from astrolode.llm.common import gathered, key_type, texts, written

TOKENS = 1 << 16
START = TOKENS - 1  # an id that no 16-bit vocabulary file of fewer tokens uses
# Tokens of a piece of a text, and of a chunk (plus at most one piece).
PIECE_TOKENS = 1 << 20
CHUNK_TOKENS = 1 << 22
# Rows of a batch of counts.
ROWS = 1 << 18


@dataclass(frozen=True)
class Smoothing:
    """`context` pseudo-counts lean a pair on its second token, `token` ones on equal chances."""

    context: float = 100.0
    token: float = 0.1


def pairs(texts: list[bytes], size: int = 1 << 20, before: list[int] | None = None
          ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every token of the texts, with its text's number and the token before it (first: that of
    `before`, or the start).

    In pieces of about `size` tokens, so that long texts need no more memory than short ones.
    """
    held, count = [], 0
    for row, ids in enumerate(texts):
        tokens = np.frombuffer(ids, "<u2")
        for at in range(0, len(tokens), size):
            second = tokens[at:at + size].astype(np.int64)
            ahead = tokens[at - 1] if at else before[row] if before else START
            first = np.concatenate(([ahead], second[:-1]))
            held.append((np.full(len(second), row), first, second))
            count += len(second)
            if count >= size:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, count = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _encoded(docs: DataFrame, targets: DataFrame, path: str) -> DataFrame:
    """Pieces of texts, written once: `doc_id`, a `row` per document, 16-bit `ids`, the token
    `ahead` of them, whether the document is a target, and the piece's `chunk`."""
    marked = targets.select("doc_id").dropna().distinct().withColumn("target", F.lit(True))
    # Labels grow with the corpus: sorted and merged at every size, as one plan for all.
    rows = texts(docs).join(marked.hint("merge"), "doc_id", "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    per_piece, per_chunk = PIECE_TOKENS, CHUNK_TOKENS

    def run(batches):
        vocab = vocabulary(path)
        row = chunk = TaskContext.get().partitionId() << 40
        size = 0
        for batch in gathered(batches, CHUNK_CHARS):
            at, rows, ids, ahead, chunks = [], [], [], [], []
            for i, x in enumerate(vocab.encode_batch(batch["text"].to_pylist())):
                tokens = np.frombuffer(x, "<u4").astype("<u2")
                for start in range(0, max(len(tokens), 1), per_piece):
                    piece = tokens[start:start + per_piece]
                    at.append(i)
                    rows.append(row)
                    ids.append(piece.tobytes())
                    ahead.append(int(tokens[start - 1]) if start else START)
                    chunks.append(chunk)
                    size += len(piece)
                    if size >= per_chunk:
                        chunk, size = chunk + 1, 0
                row += 1
            yield pa.record_batch(
                [batch["doc_id"].take(pa.array(at)), pa.array(rows), pa.array(ids, pa.binary()),
                 pa.array(ahead, pa.int32()), batch["target"].take(pa.array(at)), pa.array(chunks)],
                ["doc_id", "row", "ids", "ahead", "target", "chunk"])

    return written(rows.mapInArrow(
        run, f"doc_id {key_type(docs)}, row long, ids binary, ahead int, target boolean, chunk long"
    ), "tokens")


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Both tokens of a pair as one number, a different one for each pair."""
    return (first << 16 | second).astype(np.uint32)


def counts(encoded: DataFrame) -> DataFrame:
    """`chunk`, `pair` and both models' counts in the whole corpus, for each pair of each chunk."""
    def added_up(chunk, held):
        keys = np.concatenate([k for k, _ in held])
        own = np.concatenate([o for _, o in held])
        pair, background = np.unique(keys, return_counts=True)
        target = np.zeros(len(pair), np.int64)
        mine, n = np.unique(keys[own], return_counts=True)
        target[np.searchsorted(pair, mine)] = n
        for at in range(0, len(pair), ROWS):
            part = slice(at, at + ROWS)
            yield pa.record_batch([
                pa.array(np.full(len(pair[part]), chunk)), pa.array(pair[part].view(np.int32)),
                pa.array(target[part]), pa.array(background[part].astype(np.int64))],
                ["chunk", "pair", "target", "background"])

    def run(batches):
        # Pieces of a chunk follow each other; one read in two parts only sends some pairs twice.
        held, size, now = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            chunks, own = (batch[c].to_numpy(zero_copy_only=False) for c in ("chunk", "target"))
            ids, ahead = batch["ids"].to_pylist(), batch["ahead"].to_pylist()
            starts = np.flatnonzero(np.diff(chunks, prepend=-1)).tolist()
            for a, b in zip(starts, [*starts[1:], len(chunks)], strict=True):
                if held and (chunks[a] != now or size >= CHUNK_TOKENS):
                    yield from added_up(now, held)
                    held, size = [], 0
                now = chunks[a]
                for row, first, second in pairs(ids[a:b], before=ahead[a:b]):
                    held.append((_joined(first, second), own[a:b][row]))
                    size += len(row)
        if held:
            yield from added_up(now, held)

    parts = encoded.select("chunk", "ids", "ahead", "target").mapInArrow(
        run, "chunk long, pair int, target long, background long")
    # A pair has one row per chunk, however common it is.
    of_pair = Window.partitionBy("pair")
    return parts.select("chunk", "pair", F.sum("target").over(of_pair).alias("target"),
                        F.sum("background").over(of_pair).alias("background"))


def singles(encoded: DataFrame) -> DataFrame:
    """`kind` (0 tokens, 1 tokens as context), `token`, and both models' counts."""
    names = ["kind", "token", "target", "background"]

    def run(batches):
        sums = np.zeros((2, 2, TOKENS), np.int64)  # model, kind, token
        for batch in batches:
            own = batch["target"].to_numpy(zero_copy_only=False)
            for row, first, second in pairs(batch["ids"].to_pylist(),
                                            before=batch["ahead"].to_pylist()):
                mine = own[row]
                for kind, tokens in enumerate((second, first)):
                    sums[0, kind] += np.bincount(tokens[mine], minlength=TOKENS)
                    sums[1, kind] += np.bincount(tokens, minlength=TOKENS)
        for kind in range(2):
            at = np.flatnonzero(sums[1, kind])
            yield pa.record_batch([
                pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)),
                pa.array(sums[0, kind, at]), pa.array(sums[1, kind, at])], names)

    parts = encoded.select("ids", "ahead", "target").mapInArrow(
        run, "kind int, token int, target long, background long")
    return parts.groupBy("kind", "token").agg(
        F.sum("target").alias("target"), F.sum("background").alias("background"))


@dataclass(frozen=True)
class Model:
    """Counts of tokens and contexts; those of pairs are given where they are needed."""

    token: np.ndarray
    context: np.ndarray
    smoothing: Smoothing

    def loss(self, first: np.ndarray, second: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """-log of each token's chance after the one before it; `pair` counts both together."""
        s = self.smoothing
        alone = (self.token[second] + s.token) / (self.token.sum() + s.token * TOKENS)
        return -np.log((pair + s.context * alone) / (self.context[first] + s.context))


def models(table: DataFrame, smoothing: Smoothing = Smoothing()) -> tuple[Model, Model]:
    """Target and background from `singles`: no more rows than the vocabulary has tokens, twice."""
    got = table.toArrow()
    kind, token = (got[c].to_numpy() for c in ("kind", "token"))
    made = []
    for name in ("target", "background"):
        values, parts = got[name].to_numpy(), []
        for k in range(2):
            dense = np.zeros(TOKENS)
            dense[token[kind == k]] = values[kind == k]
            parts.append(dense)
        made.append(Model(*parts, smoothing))
    return made[0], made[1]


def score(docs: DataFrame, targets: DataFrame, path: str, smoothing: Smoothing = Smoothing()
          ) -> DataFrame:
    """`doc_id`, `n_tokens`, both models' mean losses per token and their difference.

    `targets` names the target documents by `doc_id`; without any, both models differ only by
    what the background has counted. A null text counts as empty; texts without tokens have null
    losses and a difference of 0. Repeated rows count and are scored each; rows without a
    doc_id are background. An empty table gives an empty result; extra columns are left out.
    """
    encoded = _encoded(docs, targets, path)
    # Four counts per token of the vocabulary: a fixed size, 2 MB.
    held = docs.sparkSession.sparkContext.broadcast(models(singles(encoded), smoothing))
    names = ["doc_id", "row", "n", "target", "background"]

    def run(pieces: pa.Table, known: pa.Table) -> pa.Table:
        pair = known["pair"].to_numpy().view(np.uint32)
        order = np.argsort(pair)
        pair = pair[order]
        found = [known[c].to_numpy()[order] for c in ("target", "background")]
        ids = pieces["ids"].to_pylist()
        sums = [np.zeros(len(ids)) for _ in found]
        for row, first, second in pairs(ids, before=pieces["ahead"].to_pylist()):
            at = np.searchsorted(pair, _joined(first, second))
            for total, model, n in zip(sums, held.value, found, strict=True):
                total += np.bincount(row, model.loss(first, second, n[at]), len(ids))
        sizes = np.array([len(x) // 2 for x in ids], np.int64)
        return pa.table([pieces["doc_id"], pieces["row"], pa.array(sizes), *map(pa.array, sums)],
                        names)

    pieces = encoded.select("chunk", "doc_id", "row", "ids", "ahead").groupBy("chunk").cogroup(
        counts(encoded).groupBy("chunk")).applyInArrow(
        run, f"doc_id {key_type(docs)}, row long, n long, target double, background double")
    whole = pieces.groupBy("row", "doc_id").agg(
        *(F.sum(c).alias(c) for c in ("n", "target", "background")))
    mean = [F.when(F.col("n") > 0, F.col(c) / F.col("n")) for c in ("target", "background")]
    return whole.select(
        "doc_id", F.col("n").alias("n_tokens"), mean[0].alias("target_loss"),
        mean[1].alias("background_loss"),
        F.coalesce(mean[1] - mean[0], F.lit(0.0)).alias("difference"))

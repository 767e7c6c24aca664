"""Toxicity by non-negative positive-unlabelled learning over hashed words.

A linear classifier is trained from texts confirmed as toxic and from unlabelled text. With the
class prior p the risk is estimated as

    p E+[loss(+)] + max(0, Eu[loss(-)] - p E+[loss(-)])

where the bracket is the risk on clean text, corrected for the toxic share of the unlabelled;
where a step would push it below zero, the step goes the other way for that part. With the
logistic loss the score estimates the probability of the label.

A document's features are its different words and their beginnings of several lengths, hashed to a
fixed number of weights, so that the model has a fixed size and a score is a sum over the words of
a text. A feature counts by the logarithm of how many different words have it: many words of a
stem tell more than one, and very long texts do not run away.

Batches are large, as the risk on clean text is a difference of two estimates: in small ones it
falls below zero by chance, and the steps taken back then keep the weights too low.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astrolode.llm.common import key_type, texts, written

BITS = 18
STEMS = (3, 4, 5, 6)
EDGES = ".,;:!?\"'()[]|*#$%&<>"
CACHED_WORDS = 200_000


@dataclass(frozen=True)
class Fit:
    """`max_toxic` and `max_unlabelled` bound the training sample (documents by a hash of doc_id)."""

    max_toxic: int = 3000
    max_unlabelled: int = 20_000
    epochs: int = 200
    batch: int = 1024
    rate: float = 0.1
    decay: float = 1e-4
    floor: float = 0.0
    back: float = 1.0
    surprise: float = 3.5
    least: int = 3


def words_of(text: str) -> set[str]:
    """The different words of a whole text, lower-cased, without punctuation around them."""
    return {w.strip(EDGES) for w in set(text.lower().split())}


def _slots(word: str) -> tuple[int, ...]:
    """The slots of a word and of its beginnings, each once."""
    mask = (1 << BITS) - 1
    stems = {zlib.crc32(b"^" + word[:n].encode()) & mask for n in STEMS}
    return tuple(sorted(stems | {zlib.crc32(word.encode()) & mask}))


def _times(words: int) -> int:
    """How often a feature counts that so many different words have: 1 of one, 2 of two, 3 of four."""
    return words.bit_length()


def features(text: str) -> np.ndarray:
    """The slots of a text's features, each as often as it counts."""
    found = Counter(s for w in words_of(text) if w for s in _slots(w))
    return np.array(sorted(s for s, n in found.items() for _ in range(_times(n))), np.int32)


def telling(found: np.ndarray, toxic: int, among: np.ndarray, unlabelled: int, fit: Fit) -> np.ndarray:
    """Which slots occur in toxic texts much more, or less, often than in unlabelled ones.

    More than `surprise` standard deviations from what the unlabelled rate leads to expect, in
    at least `least` toxic texts where it is more. All other slots keep a weight of zero. `found` and
    `among` count the toxic and the unlabelled texts that have each slot.
    """
    rate = (among + 1) / (unlabelled + 2)
    expected = toxic * rate
    z = (found - expected) / np.sqrt(np.maximum(expected * (1 - rate), 1e-9))
    return (z >= fit.surprise) & (found >= fit.least) | (z <= -fit.surprise)


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _logits(weights, bias, slots, sizes):
    starts = np.cumsum(sizes) - sizes
    sums = np.add.reduceat(np.append(weights[slots], 0.0), starts) if len(sizes) else np.zeros(0)
    return np.where(sizes > 0, sums, 0.0) + bias


def _batches(rows: list[np.ndarray], count: int, rng) -> list[list[np.ndarray]]:
    order = rng.permutation(len(rows))
    return [[rows[i] for i in part] for part in np.array_split(order, count)]


def train(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
          fit: Fit = Fit(), seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias from rows of telling slots. Without toxic or unlabelled examples the score
    is the prior's for all.
    """
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    weights, bias = np.zeros(1 << BITS), float(np.log(prior / (1 - prior)))
    if not toxic or not unlabelled:
        return weights, bias
    rng = np.random.default_rng(seed)
    squares, bias_square = np.full(1 << BITS, 1e-8), 1e-8
    steps = max(1, len(unlabelled) // fit.batch)
    for _ in range(fit.epochs):
        # Toxic examples are few: each unlabelled batch meets its share of them.
        pairs = zip(_batches(toxic, steps, rng), _batches(unlabelled, steps, rng), strict=True)
        for pos, unl in pairs:
            if not pos:
                pos = [toxic[i] for i in rng.integers(0, len(toxic), 8)]
            rows = pos + unl
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            slots = np.concatenate(rows)
            logit = _logits(weights, bias, slots, sizes)
            p, u = logit[:len(pos)], logit[len(pos):]
            clean = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
            grad_p = -prior * _sigmoid(-p) / len(pos)
            clean_p, clean_u = -prior * _sigmoid(p) / len(pos), _sigmoid(u) / len(unl)
            if clean < -fit.floor:  # as in non-negative PU learning: undo the over-fitting part
                grad = np.concatenate((-fit.back * clean_p, -fit.back * clean_u))
            else:
                grad = np.concatenate((grad_p + clean_p, clean_u))
            by_slot = np.bincount(slots, np.repeat(grad, sizes), 1 << BITS).astype(float)
            by_slot += fit.decay * weights
            squares += by_slot ** 2
            weights -= fit.rate * by_slot / np.sqrt(squares)
            bias_square += grad.sum() ** 2
            bias -= fit.rate * grad.sum() / np.sqrt(bias_square)
    return weights, float(bias)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: CRC-32 of the id as text, modulo 4, is 2."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 4 == 2


@dataclass(frozen=True)
class Model:
    """The weights that are not zero, by slot."""

    weights: dict[int, float]
    bias: float

    def scores(self, batch: list[str], cache: dict[str, tuple[int, ...]]) -> np.ndarray:
        logits = np.full(len(batch), self.bias)
        for i, text in enumerate(batch):
            held: Counter[int] = Counter()
            seen: set[str] = set()
            for raw in set(text.lower().split()):
                slots = cache.get(raw)
                if slots is None:
                    word = raw.strip(EDGES)
                    slots = tuple(s for s in _slots(word) if s in self.weights) if word else ()
                    if len(cache) < CACHED_WORDS:
                        cache[raw] = slots
                if slots and (word := raw.strip(EDGES)) not in seen:
                    seen.add(word)
                    held.update(slots)
            logits[i] += sum(self.weights[s] * _times(n) for s, n in sorted(held.items()))
        return _sigmoid(logits)


def _telling_slots(rows: DataFrame, fit: Fit) -> np.ndarray:
    """`telling` of the sample's features; the driver gets one row per slot."""
    def count(batches):
        sums, texts_ = {}, {}
        for batch in batches:
            for role, slots in zip(batch["role"].to_pylist(), batch["slots"].to_pylist(), strict=True):
                held = sums.setdefault(role, np.zeros(1 << BITS, np.int64))
                held[np.unique(np.frombuffer(slots, np.int32))] += 1
                texts_[role] = texts_.get(role, 0) + 1
        for role, held in sums.items():
            at = np.flatnonzero(held)  # slot -1 counts the texts
            yield pa.record_batch([
                pa.array([role] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)),
                pa.array(np.append(held[at], texts_[role]))], ["role", "slot", "n"])

    parts = rows.select("role", "slots").mapInArrow(count, "role string, slot int, n long")
    got = parts.groupBy("role", "slot").agg(F.sum("n").alias("n")).toArrow()
    role, slot, n = (np.array(got[c].to_pylist()) for c in ("role", "slot", "n"))
    counts = []
    for wanted in ("toxic", "unlabelled"):
        own = (role == wanted) & (slot >= 0) if len(role) else np.zeros(0, bool)
        dense = np.zeros(1 << BITS, np.int64)
        dense[slot[own].astype(int)] = n[own]
        total = int(n[(role == wanted) & (slot < 0)].sum()) if len(role) else 0
        counts += [dense, total]
    return telling(*counts, fit)


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Train on a bounded sample of labelled rows that are not held out.

    Toxic examples are rows with the label 1; the unlabelled ones are drawn from all labelled
    rows without looking at their label, and the class prior is the toxic share of all of them.
    Rows without an id or a label are not used; of several labels of a document the largest
    counts, of several texts the one with the smallest hash. Texts are turned into features where they lie; what reaches the driver is bounded
    by the sample sizes.
    """
    known = (
        labels.select("doc_id", "toxic").dropna().groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out(F.col("doc_id")))
    )
    total = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).first()
    draw = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))

    def drawn(rows: DataFrame, count: int, role: str) -> DataFrame:
        return rows.orderBy(draw, "doc_id").limit(count).select("doc_id", F.lit(role).alias("role"))

    chosen = drawn(known.filter("toxic = 1"), fit.max_toxic, "toxic").unionByName(
        drawn(known, fit.max_unlabelled, "unlabelled"))

    def run(batches):
        for batch in batches:
            slots = [features(t).tobytes() for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], batch["role"], pa.array(slots, pa.binary())],
                                  ["doc_id", "role", "slots"])

    # At most the two sample sizes of ids, so this side is small by construction.
    # A document counts once, however many rows it has; each task sends on one of them.
    least = F.min(F.struct(F.xxhash64("text").alias("tie"), "text"))
    sample = texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "role").agg(
        least.alias("least")).select("doc_id", "role", "least.text")
    rows = written(
        sample.mapInArrow(run, f"doc_id {key_type(docs)}, role string, slots binary"), "features")
    use = _telling_slots(rows, fit)

    def pick(batches):
        for batch in batches:
            slots = [np.frombuffer(s, np.int32) for s in batch["slots"].to_pylist()]
            few = pa.array([s[use[s]].tobytes() for s in slots], pa.binary())
            yield pa.record_batch([batch["doc_id"], batch["role"], few], ["doc_id", "role", "slots"])

    few = rows.mapInArrow(pick, rows.schema)
    made = sorted(((r["doc_id"], r["role"], r["slots"]) for r in few.collect()))
    parts = {
        role: [np.frombuffer(s, np.int32) for _, r, s in made if r == role]
        for role in ("toxic", "unlabelled")
    }
    prior = (total["k"] or 0) / max(total["n"], 1)
    weights, bias = train(parts["toxic"], parts["unlabelled"], prior, fit)
    used = np.flatnonzero(weights)
    return Model(dict(zip(used.tolist(), weights[used].tolist(), strict=True)), bias)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every whole text.

    A null text counts as empty; empty texts get the score of a text without any known word.
    Rows never move; repeated rows give repeated results, an empty table an empty one. Only the
    text is an input of a score; extra columns are left out.
    """
    def run(batches):
        cache: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            scores = model.scores(batch["text"].to_pylist(), cache)
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(scores)],
                                  ["doc_id", "held_out", "score"])

    rows = texts(docs).withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        run, f"doc_id {key_type(docs)}, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents the model does not reject, all their columns as they are."""
    def run(batches):
        cache: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            plain = [t or "" for t in batch["text"].to_pylist()]
            yield batch.filter(pa.array(model.scores(plain, cache) < threshold))

    return docs.mapInArrow(run, docs.schema)

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from astrolode.llm import lm_score, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows, targets, smoothing):
    library = Tokenizer.from_file(PATH)
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    models = []
    for chosen in ([x for (i, _), x in zip(rows, ids, strict=True) if i in targets], ids):
        token, pair, context = Counter(), Counter(), Counter()
        for x in chosen:
            for a, b in zip([lm_score.START, *x], x, strict=False):
                token[b] += 1
                context[a] += 1
                pair[a, b] += 1
        models.append((token, pair, context, sum(token.values())))
    out = []
    for (i, _), x in zip(rows, ids, strict=True):
        losses = []
        for token, pair, context, total in models:
            loss = 0.0
            for a, b in zip([lm_score.START, *x], x, strict=False):
                alone = (token[b] + smoothing.token) / (total + smoothing.token * lm_score.TOKENS)
                loss -= math.log((pair[a, b] + smoothing.context * alone) / (context[a] + smoothing.context))
            losses.append(loss / len(x) if x else None)
        out.append((str(i), len(x), *losses))
    return sorted(out, key=lambda r: (r[0], r[1], r[2] or 0))


@pytest.mark.parametrize("targets", [[7, 10, 40, 43, 46, 49], []])
def test_against_brute_force(spark, odd_docs, odd_rows, targets):
    frame = spark.createDataFrame([(i,) for i in [*targets, *targets, 999_999, None]], "doc_id long")
    smoothing = lm_score.Smoothing(7.0, 0.5)
    got = sorted(((str(r["doc_id"]), r["n_tokens"], r["target_loss"], r["background_loss"])
                  for r in lm_score.score(odd_docs, frame, PATH, smoothing).collect()),
                 key=lambda r: (r[0], r[1], r[2] or 0))
    for a, b in zip(got, brute(odd_rows, set(targets), smoothing), strict=True):
        assert a[:2] == b[:2]
        assert a[2:] == pytest.approx(b[2:], rel=1e-5) if b[2] is not None else a[2:] == (None, None)


def test_empty(spark, no_docs):
    none = spark.createDataFrame([], "doc_id long")
    assert lm_score.score(no_docs, none, PATH).collect() == []


def test_tells_good_from_poor_text_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.held_out(F.col("doc_id"))
    rows = lm_score.score(docs, labels.filter(~held & (F.col("quality") == 1)), PATH).join(
        labels.filter(held), "doc_id").select("difference", "quality").toPandas()
    rank = rows["difference"].rank()
    good = rows["quality"] == 1
    n = good.sum()
    assert (rank[good].sum() - n * (n + 1) / 2) / (n * (len(rows) - n)) > 0.95


def test_long_texts_come_in_pieces():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 49_000, n).astype("<u2").tobytes() for n in (0, 5, 1000, 1, 0, 250)]
    whole = [np.concatenate(x) for x in zip(*lm_score.pairs(texts), strict=True)]
    parts = [np.concatenate(x) for x in zip(*lm_score.pairs(texts, 64), strict=True)]
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert max(len(row) for row, _, _ in lm_score.pairs(texts, 64)) < 2 * 64
    assert list(lm_score.pairs([])) == [] and list(lm_score.pairs([b""])) == []


def test_many_different_pairs(spark, docs_of):
    library = Tokenizer.from_file(PATH)
    rng = np.random.default_rng(2)
    some = [w for w in (library.decode([int(i)]).strip() for i in rng.integers(1000, 49_000, 9000))
            if w.isascii() and w.isalpha()]
    rows = [(i, " ".join(rng.choice(some, 2000))) for i in range(60)]
    smoothing = lm_score.Smoothing(0.5, 0.5)
    targets = set(range(0, 60, 7))
    frame = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    want = {i: values for i, *values in brute(rows, targets, smoothing)}
    got = lm_score.score(docs_of(rows).repartition(3), frame, PATH, smoothing).collect()
    assert len(got) == len(rows)
    for r in got:
        n, target, background = want[str(r["doc_id"])]
        assert r["n_tokens"] == n
        assert (r["target_loss"], r["background_loss"]) == pytest.approx((target, background), rel=1e-9)


def test_pieces_and_chunks_change_nothing(spark, docs_of, monkeypatch):
    rows = [(i, " ".join(f"word{(i * j) % 37}" for j in range(200 * (i % 5)))) for i in range(12)]
    frame = spark.createDataFrame([(2,), (3,)], "doc_id long")
    docs = docs_of(rows).coalesce(2)

    def got():
        return {r["doc_id"]: r for r in lm_score.score(docs, frame, PATH).collect()}

    whole = got()
    monkeypatch.setattr(lm_score, "PIECE_TOKENS", 64)
    monkeypatch.setattr(lm_score, "CHUNK_TOKENS", 100)
    small = got()
    assert whole.keys() == small.keys() and len(whole) == 12
    for i, r in whole.items():
        assert small[i]["n_tokens"] == r["n_tokens"]
        assert small[i]["difference"] == pytest.approx(r["difference"], abs=1e-12)
        assert small[i]["target_loss"] == (pytest.approx(r["target_loss"]) if r["n_tokens"] else None)

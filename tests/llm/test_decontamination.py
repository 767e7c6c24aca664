import random
import re

import pytest
from pyspark.sql import functions as F

from astrolode.llm import decontamination

BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in BETWEEN.split((text or "").translate(LOWER)) if w]


def brute(docs, items):
    windows = {}
    for i, text in items:
        t = words(text)
        size = min(10, len(t))
        for k in range(len(t) - size + 1 if t else 0):
            windows.setdefault(tuple(t[k:k + size]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        t, hit, named = words(text), set(), set()
        for size in sizes:
            for k in range(len(t) - size + 1):
                if found := windows.get(tuple(t[k:k + size])):
                    hit |= set(range(k, k + size))
                    named |= found
        spans = []
        for p in sorted(hit):
            if spans and spans[-1][1] == p:
                spans[-1][1] += 1
            else:
                spans.append([p, p + 1])
        out.append((str(i), len(t), str(spans), sorted(named)))
    return sorted(out)


def found(df):
    return sorted((str(r["doc_id"]), r["n_words"], str([list(s) for s in r["spans"]]), r["items"])
                  for r in df.collect())


@pytest.fixture
def items_of(spark):
    def make(rows):
        schema = "item_id long, text string, " + ", ".join(f"{c} string" for c in (
            "window", "size", "known", "shared", "tokens", "_row", "doc_id", "start", "index"))
        return spark.createDataFrame([(i, t, *["?"] * 9) for i, t in rows], schema)

    return make


def made(odd_rows, short):
    rnd = random.Random(3)
    texts = [t for _, t in odd_rows if t and len(words(t)) > 25]
    items = [(1, None), (2, ""), (3, " ."), (None, " ".join(words(texts[0])[:14]))]
    for k in range(40):
        t = words(rnd.choice(texts))
        at = rnd.randrange(len(t) - 20)
        items.append((k % 35 + 10, " - ".join(t[at:at + rnd.randrange(10, 25)]).upper()))
    items.append((70, items[5][1]))
    if short:
        items += [(80, "Idiot  Trash"), (81, "seven"), (82, " ".join(words(texts[3])[2:9])), (83, "ünder")]
    planted = [(5000 + k, f"Before that {t} and after.") for k, (_, t) in enumerate(items)]
    planted += [(6000, "a " * 60), (6001, "b a b a " * 8 + "A a a a a a a a a a a")]
    items += [(90, "a " * 11), (91, "b a " * 7), (91, "a b " * 9)]
    return [*odd_rows, *planted], items


@pytest.mark.parametrize("short", [False, True])
@pytest.mark.parametrize("broadcast_bytes", [decontamination.BROADCAST_BYTES, 0])
def test_against_brute_force(docs_of, items_of, odd_rows, short, broadcast_bytes):
    docs, items = made(odd_rows, short)
    want = brute(docs, items)
    got = decontamination.find(docs_of(docs).repartition(5), items_of(items), broadcast_bytes)
    assert found(got) == want
    assert sum(w[2] != "[]" for w in want) > 40 and sum(w[2] == "[]" for w in want) > 20


def test_empty(docs_of, items_of, no_docs):
    assert decontamination.find(no_docs, items_of([(1, "some words")])).collect() == []
    none = decontamination.find(docs_of([(1, "some words"), (2, None)]), items_of([(1, " ")]))
    assert found(none) == [("1", 2, "[]", []), ("2", 0, "[]", [])]


def test_only_a_to_z_are_lower_cased(docs_of, items_of):
    text = "ÄPFEL und ÉCLAIRS İ Σ Ⅷ Ⓐ sind hier zu Hause"
    got = found(decontamination.find(
        docs_of([(1, text), (2, text.lower()), (3, text.translate(LOWER)), (4, text + " ﬁ")]),
        items_of([(7, text)])))
    assert [(g[0], g[3]) for g in got] == [("1", ["7"]), ("2", []), ("3", ["7"]), ("4", ["7"])]


def test_winnowing_keeps_a_hash_of_every_window(spark):
    rnd = random.Random(5)
    tokens = [rnd.choice("abcdefgh") for _ in range(300)]
    rows = decontamination.fingerprints(spark.createDataFrame([(tokens,)], "tokens array<string>"), 10).collect()
    gram = decontamination.GRAM
    kept = {r["last"] if r["last"] < 290 else None for r in rows}
    assert 300 // 10 < len(rows) < 150  # about a quarter
    for k in range(280):
        assert kept & set(range(k, k + 10 - gram + 1))
    assert all(r["first"] <= r["last"] < r["first"] + 10 for r in rows)


def test_dataframe_functions_only(docs_of, items_of, plan_of):
    plan = plan_of(decontamination.find(docs_of([(1, "some words")] * 3), items_of([(1, "some words")])))
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_frequent_passage_makes_no_pairs(spark, docs_of, items_of):
    passage = "one passage of a dozen words that very many of them hold"
    docs = docs_of([(i, f"{passage} x{i}") for i in range(400)])
    items = items_of([(i, f"{passage} y{i}") for i in range(300)])
    benchmark = decontamination.Benchmark(items)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"),
                       decontamination.words(F.col("text")).alias("tokens"))
    assert decontamination.shared_windows(rows, benchmark, 10).count() < 400 * 15

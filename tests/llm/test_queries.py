"""The registered queries and the pipeline over the smallest given tables."""

import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from astrolode.llm import toxicity
from astrolode.llm.queries import ORACLES, QUERIES, WORD_BPE
from check import connect, rows_of
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2": "page_id url text n_chars",
    "op3": "doc_id keep_id group_size kept text_sha256",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6": "doc_id fingerprint component_id",
    "op7": "doc_id size text_crc32 law shard slot grown_shard",
    "op8": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9": "doc_id n_tokens target_loss background_loss difference",
    "op10": "page_id host path rule verdict",
    "op11": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13": "doc_id n_words n_hit n_items items_sha256 contaminated",
}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert {q.split("_")[0] for q in QUERIES} == set(COLUMNS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_whole_tables(spark, name):
    df = entry.queries()[name](spark, SF)
    op = name.split("_")[0]
    assert df.columns == COLUMNS[op].split()
    given = spark.read.parquet(f"{SF}/{'pages' if op in ('op2', 'op10') else 'documents'}.parquet")
    key = df.columns[0]
    assert {r[0] for r in df.select(key).collect()} == {r[0] for r in given.select(key).collect()}


@pytest.mark.parametrize("name", list(ORACLES))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_same_as_sql(spark, name, scale):
    df = entry.queries()[name](spark, f"/root/testdata/{scale}")
    answer = connect(f"/root/testdata/{scale}").execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, answer.fetchall())


def planted(docs):
    """The given documents with copies, and near copies of the longer ones."""
    row = docs.orderBy(F.length("text").desc()).limit(12)
    copies = row.withColumn("doc_id", F.col("doc_id") + 100_000)
    near = row.withColumn("doc_id", F.col("doc_id") + 200_000).withColumn("text", F.concat("text", F.lit(" end")))
    return docs.unionByName(copies).unionByName(near)


def test_pipeline_against_brute_force(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = planted(docs)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(r["doc_id"], r["text"] or "") for r in docs.orderBy("doc_id").collect()]
    scores = toxicity.learn(docs, labels).scores([t for _, t in rows], {})
    rows = [row for row, s in zip(rows, scores, strict=True) if s < 0.3]
    seen, different = set(), []
    for i, t in rows:
        norm = re.sub("[\x20\x09-\x0d]+", " ", t)
        if norm not in seen:
            seen.add(norm)
            different.append((i, t))
    part = brute_components([brute_fingerprint(t) for _, t in different])
    left = [different[k] for k in range(len(different)) if part[k] == k]
    assert 0 < len(left) < len(different) < len(rows) < docs.count()
    library = Tokenizer.from_file(WORD_BPE)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in left}
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "packing"]


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, given, SF)
            assert (rows.count() > 0) == (given is odd_docs)

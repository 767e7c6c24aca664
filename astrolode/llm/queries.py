"""The registered queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from astrolode.llm import (
    alignment,
    bpe,
    decontamination,
    exact_dedup,
    fingerprints,
    html_crf,
    lm_score,
    packing,
    runs,
    sharding,
    simhash,
    toxicity,
    url_filter,
)
from astrolode.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

SITE_RULES = [
    url_filter.site_rule(url_filter.BLOCK, "net/"),
    url_filter.site_rule(url_filter.ALLOW, "example.net/en/"),
    url_filter.site_rule(url_filter.BLOCK, "example.com/de/"),
    url_filter.site_rule(url_filter.ALLOW, "org/fr/"),
]
WORD_RULES = [url_filter.word_rule(url_filter.BLOCK, w) for w in ("casino", "poker", "betting")]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.learn(pages))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_versions(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is text labelled as of good quality, without the rows that are held out."""
    labels = table(spark, sf_dir, "labels")
    good = labels.filter((F.col("quality") == 1) & ~toxicity.held_out(F.col("doc_id")))
    return lm_score.score(table(spark, sf_dir, "documents"), good, WORD_BPE)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), SITE_RULES + WORD_RULES)


def _whole(value: Column, by: Column | int) -> Column:
    """Whole-number division of numbers that are not negative."""
    return ((value - value % by) / by).cast("long")


def with_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text`; where h, the CRC-32 of the id, is a multiple of 10, the words from a on
    repeat the first p of them, for a and p that follow from h."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    chosen = docs.select("doc_id", "text", _whole(h, 10).alias("g"),
                         F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.col("g")
    cut = chosen.withColumn("n", n).withColumn("a", F.when(n > 0, (g % n).cast("int")))
    a = F.col("a")
    p = (1 + _whole(F.col("n") - a, 3 + g % 8)).cast("int")
    repeated = F.transform(F.sequence(a, F.col("n") - 1), lambda i: F.get(
        "words", F.col("a") + (i - F.col("a")) % F.col("p")))
    edited = F.concat_ws(" ", F.concat(F.slice("words", F.lit(1), a), repeated))
    return cut.withColumn("p", p).select(
        "doc_id", F.when(a.isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse(with_repeats(table(spark, sf_dir, "documents")))
    # The run with the greatest length / period, compared exactly; the first one of equals.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        _whole(1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.statistics(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


QUERIES: dict[str, Query] = {
    q.__name__: q for q in (
        op1_bpe, op2_html_crf, op3_exact_dedup, op4_toxicity, op5_fingerprints, op6_simhash,
        op7_sharding, op8_packing, op9_lm_score, op10_url_filter, op11_runs, op12_alignment,
        op13_decontamination)
}

ORACLES = {
    "op3_exact_dedup": r"""
        WITH n AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
          FROM documents),
        g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
          sha256(norm) AS text_sha256
        FROM n JOIN g USING (norm)""",
    "op10_url_filter": r"""
        WITH r AS (
          SELECT page_id, CASE WHEN instr(url, '://') > 0
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        p AS (
          SELECT page_id,
            translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        v AS (
          SELECT *, CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
              THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
              THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
            END AS rule FROM p)
        SELECT page_id, host, path, rule, CASE
          WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
          WHEN regexp_matches(host, '(^|[^a-z0-9])(casino|poker|betting)([^a-z0-9]|$)') THEN 'block'
          ELSE 'allow' END AS verdict
        FROM v""",
    "op11_runs": r"""
        WITH d AS (
          SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS t,
            xor(4294967295, list_reduce(
              list_prepend(4294967295::BIGINT, list_transform(
                string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
              lambda crc, byte: list_reduce(
                list_prepend(xor(crc, byte), range(8)),
                lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) AS h
          FROM documents),
        e AS (SELECT *, len(t) AS n, CASE WHEN h % 10 = 0 AND len(t) > 0 THEN (h // 10) % len(t) END AS a
              FROM d),
        x AS (SELECT row, doc_id, n, CASE WHEN a IS NULL THEN t ELSE list_transform(range(n), lambda i:
                t[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1])
              END AS t FROM e),
        w AS (SELECT row, n, i, t[i + 1] AS word FROM (
              SELECT *, unnest(range(n)) AS i FROM x)),
        same AS (SELECT l.row, r.i - l.i AS q, l.i FROM w l JOIN w r
                 ON l.row = r.row AND l.word = r.word AND l.i < r.i AND (r.i - l.i) * 4 <= l.n),
        grouped AS (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS part FROM same),
        stretch AS (SELECT row, min(i) AS s, count(*) + q AS len, q FROM grouped GROUP BY row, q, part
                    HAVING count(*) + q >= greatest(6, 4 * q)),
        run AS (SELECT * FROM stretch a WHERE NOT EXISTS (
                SELECT 1 FROM stretch b WHERE a.row = b.row AND b.q < a.q AND b.s <= a.s
                  AND b.s + b.len >= a.s + a.len)),
        listed AS (SELECT row, count(*) AS n_runs,
            string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
            first(s ORDER BY len::DECIMAL(38, 0) * 1000000000 // q DESC, s, q) AS start,
            first(len ORDER BY len::DECIMAL(38, 0) * 1000000000 // q DESC, s, q) AS length,
            first(q ORDER BY len::DECIMAL(38, 0) * 1000000000 // q DESC, s, q) AS period
          FROM run GROUP BY row),
        gone AS (SELECT DISTINCT row, unnest(range(s + q, s + len)) AS i FROM run),
        kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM w
                 ANTI JOIN gone USING (row, i) GROUP BY row)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
          1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
          sha256(coalesce(text, '')) AS collapsed_sha256
        FROM x LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)""",
    "op13_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM documents),
        b AS (SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM benchmark),
        bw AS (
          SELECT DISTINCT item_id, size, list_aggregate(t[i:i + size - 1], 'string_agg', ' ') AS w
          FROM (SELECT item_id, t, size, unnest(range(1, len(t) - size + 2)) AS i
                FROM (SELECT *, least(len(t), 10) AS size FROM b WHERE len(t) > 0))),
        dw AS (
          SELECT doc_id, i, size, list_aggregate(t[i:i + size - 1], 'string_agg', ' ') AS w
          FROM (SELECT doc_id, t, size, unnest(range(1, len(t) - size + 2)) AS i
                FROM d, (SELECT DISTINCT size FROM bw))),
        hits AS (SELECT doc_id, i, size, item_id FROM dw JOIN bw USING (size, w)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
            SELECT doc_id, unnest(range(i, i + size)) AS p FROM (
              SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
        its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (
            SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(t) AS BIGINT) AS n_words,
          CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
          sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
}

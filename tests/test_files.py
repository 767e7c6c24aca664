import pytest
from pyspark.sql import types as T

from astrolode.session import build_session, shared_dir, shuffle_partitions
from astrolode.sources import files, sinks


def test_csv_header_bom_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('﻿id , name,note\r\n1,"say ""hi""","two\nlines"\r\n,,\r\n2,x,\r\n'.encode())
    df = files.read_csv(spark, str(path))
    assert df.columns == ["id", "name", "note"]
    assert [tuple(r) for r in df.collect()] == [
        ("1", 'say "hi"', "two\nlines"), (None, None, None), ("2", "x", None),
    ]
    assert files.read_csv(spark, str(path), infer=True).schema["id"].dataType == T.IntegerType()
    typed = files.read_csv(spark, str(path), schema="a INT, b STRING, c STRING")
    assert [r.a for r in typed.collect()] == [1, None, 2]
    assert files.read_csv(spark, str(path), multi_line=False).count() > df.count()


def test_undeclared_fields_are_kept_beside_declared_ones(spark, tmp_path):
    lines = ['{"id": "1", "extra": 2.5, "deep": {"a": [1]}}', '{"id": "2"}', "", "  ", "{broken", '{"none": null, "id": "3"}']
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    df = files.read_landing(spark, str(tmp_path), files.landing_schema("id STRING, gone INT"))
    assert df.columns == ["id", "gone", "ingestion_time", "_corrupt_record", "_undeclared", "source_file"]
    rows = {(r.id, r._corrupt_record): r for r in df.collect()}
    assert len(rows) == 4
    assert rows["1", None]._undeclared == {"extra": "2.5", "deep": '{"a":[1]}'}
    assert rows["2", None]._undeclared is None
    assert rows[None, "{broken"]._undeclared is None
    assert rows["3", None]._undeclared == {"none": None}
    assert all(r.source_file.endswith("/a.json") for r in rows.values())
    assert files.read_json_lines(spark, str(tmp_path / "a.json")).columns[-1] == "none"


def test_absent_sources(spark, tmp_path):
    assert files.or_none(lambda: spark.read.parquet(str(tmp_path / "none"))) is None
    assert files.or_none(lambda: spark.read.parquet(str(tmp_path))) is None
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        files.or_none(lambda: spark.range(1).select("nope"))


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    results = files.read_all({
        "gone": lambda: files.read_csv(spark, str(tmp_path / "gone.csv")),
        "here": lambda: spark.range(3),
        "broken": lambda: spark.read.parquet(str(tmp_path / "broken")),
    })
    assert results["broken"].df is None and results["broken"].error
    assert results["gone"].df is None and results["gone"].error == "PATH_NOT_FOUND"
    assert results["here"].df.count() == 3 and results["here"].error is None


def test_json_batch_keeps_null_fields(spark, tmp_path):
    path = str(tmp_path / "batch")
    sinks.write_json_lines(spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS name"), path)
    assert spark.read.text(path).first()[0] == '{"id":1,"name":null}'
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_json_lines(spark.range(1), path)


def test_append_and_overwrite_report_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.append_parquet(spark.range(5), path) == 5
    assert sinks.append_parquet(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 8
    assert sinks.overwrite_parquet(spark.range(2), path) == 2
    assert spark.read.parquet(path).count() == 2
    assert sinks.overwrite_parquet(spark.range(0), path) == 0
    assert spark.read.parquet(path).columns == ["id"]


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path, conf):
    conf(adaptive__advisoryPartitionSizeInBytes="20KB", adaptive__coalescePartitions__minPartitionSize="1KB")
    df = spark.range(0, 60000, 1, 6).selectExpr("uuid() AS v", "IF(id % 3 = 0, 1, 2 + id % 2) AS year")
    path = tmp_path / "t"
    assert sinks.overwrite_parquet(df, str(path), ["year"]) == 60000
    assert len(list((path / "year=1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).filter("year = 1").count() == 20000


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, conf, plan_of):
    conf(autoBroadcastJoinThreshold="-1")
    left, right = spark.range(200).selectExpr("id % 50 AS k", "id AS v"), spark.range(50).selectExpr("id AS k", "id AS w")
    try:
        assert sinks.overwrite_bucketed(left, "bucket_l", str(tmp_path / "l"), 4, ["k"]) == 200
        sinks.overwrite_bucketed(right, "bucket_r", str(tmp_path / "r"), 4, ["k"])
        joined = spark.table("bucket_l").join(spark.table("bucket_r"), "k")
        assert joined.count() == 200
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.sql("DROP TABLE IF EXISTS bucket_l")
        spark.sql("DROP TABLE IF EXISTS bucket_r")


def test_connector_gets_the_table_as_option():
    target = sinks.connector("jdbc", {"url": "u"})
    assert target.format == "jdbc"
    assert target.options_for("FACT") == {"url": "u", "dbtable": "FACT"}


def test_file_and_catalog_targets(spark, tmp_path):
    df = spark.range(4)
    target = sinks.files("json", str(tmp_path / "out"))
    assert target.write(df, "T") == 4 and target.write(spark.range(1), "T") == 1
    assert spark.read.json(str(tmp_path / "out" / "T")).count() == 1
    try:
        catalog = sinks.CatalogTarget("default", str(tmp_path / "tables"))
        assert catalog.write(df, "published_t") == 4
        assert catalog.write(spark.range(2), "published_t") == 2
        assert spark.table("default.published_t").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS default.published_t")


def test_session_settings(spark):
    assert build_session("again") is not None
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(100 * 10**12, 4000) > 400_000
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_scratch_needs_a_shared_folder_off_a_local_session():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")

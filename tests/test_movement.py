"""Ingest, loading, SQL steps, audit, schema registry. No database is involved."""

import glob
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakerecon import (
    AuditStamp,
    BatchSpec,
    HighWater,
    IngestSpec,
    LoadSpec,
    SchemaRegistry,
    append_audit,
    append_failures,
    counted,
    export_missing,
    hash_predicates,
    ingest_history,
    load_history,
    load_jdbc,
    payload_schema,
    quarantine,
    read_events,
    read_increment,
    read_jdbc,
    read_jdbc_hashed,
    reload_jdbc,
    repair_table,
    run_batch,
    run_sql_step,
    schema_diff,
    shared_dir,
    verify_load,
    write_options,
    write_raw,
)
from lakerecon.functions.schemas import as_nullable, as_struct
from lakerecon.sources.increments import read_up_to

STAMP = AuditStamp("r1", datetime(2024, 7, 1, 12))


@pytest.fixture
def feed(spark):
    rows = [(datetime(2024, 1, 1, h), h * 10, p) for h, p in enumerate(['{"k": 1}', '{"k": 2', None, '{"k": 4}'])]
    return spark.createDataFrame(rows, "at timestamp_ntz, id bigint, payload string")


def spec(folder, **more):
    base = dict(
        job="j", payload="payload", payload_schema="k BIGINT", bookmark_keys=["at", "id"], out=f"{folder}/raw", quarantine=f"{folder}/err"
    )
    return IngestSpec(**{**base, **more})


def test_ingest_lands_quarantines_and_moves_on(spark, feed, folder):
    marks = HighWater(spark, f"{folder}/marks", "j")
    got = ingest_history(feed, spec(folder), marks, date(2024, 2, 1))
    assert (got.read, got.written, got.quarantined) == (4, 2, 2)
    assert marks.load().asDict() == {"at": datetime(2024, 1, 1, 3), "id": 30}
    again = ingest_history(feed, spec(folder), marks, date(2024, 2, 2))
    assert again.read == 0
    more = feed.unionAll(spark.createDataFrame([(datetime(2024, 1, 1, 3), 31, '{"k": 5}')], feed.schema))
    third = ingest_history(more, spec(folder), marks, date(2024, 2, 3))
    assert (third.read, third.quarantined) == (1, 0)
    landed = read_events(spark, f"{folder}/raw", schema="k BIGINT, event_creation_time DATE")
    assert sorted((r[0], str(r[1])) for r in landed.collect()) == [(1, "2024-02-01"), (4, "2024-02-01"), (5, "2024-02-03")]
    assert glob.glob(f"{folder}/raw/event_creation_time=2024-02-01/ingest_batch=j-1/*.json.gz")
    bad = spark.read.json(f"{folder}/err")
    assert {str(r["event_creation_time"]) for r in bad.collect()} == {"2024-02-01"}
    assert sorted(r["id"] for r in bad.collect()) == [10, 20]


@pytest.mark.parametrize("batch_column, rows", [("ingest_batch", 3), (None, 5)])
def test_a_run_repeated_on_another_day(spark, feed, folder, batch_column, rows):
    """The mark could not be written: the next run replaces the files, unless it appends plainly."""
    marks, plan = HighWater(spark, f"{folder}/marks", "j"), spec(folder, batch_column=batch_column)
    marks.commit, real = (lambda *a: (_ for _ in ()).throw(OSError("no space"))), marks.commit
    with pytest.raises(OSError):
        ingest_history(feed, plan, marks, date(2024, 2, 1))
    marks.commit = real
    more = feed.unionAll(spark.createDataFrame([(datetime(2024, 1, 1, 5), 50, '{"k": 5}')], feed.schema))
    assert ingest_history(more, plan, marks, date(2024, 2, 2)).written == 3
    landed = spark.read.json(f"{folder}/raw")
    assert landed.count() == rows
    assert {str(r["event_creation_time"]) for r in landed.collect()} == {"2024-02-01"}
    assert spark.read.json(f"{folder}/err").count() == (2 if batch_column else 4)


def test_ingest_into_one_partition_with_other_task_counts(spark, feed, folder):
    one = spec(folder, partition_value="initial", min_partitions=3, files=1)
    ingest_history(feed, one, HighWater(spark, f"{folder}/marks", "j"), date(2024, 2, 1))
    assert len(glob.glob(f"{folder}/raw/event_creation_time=initial/*/*.json.gz")) == 1


def test_ingest_of_null_keys_loses_nothing(spark, folder):
    df = spark.createDataFrame([(None, 1, '{"k": 1}'), (None, 2, "broken"), (datetime(2024, 1, 1), 3, '{"k": 3}')], "at timestamp_ntz, id bigint, payload string")
    got = ingest_history(df, spec(folder), HighWater(spark, f"{folder}/marks", "j"), date(2024, 2, 1))
    assert (got.written, got.quarantined) == (2, 1)
    assert spark.read.json(f"{folder}/err").count() == 1


def test_a_failed_sink_does_not_move_the_mark(spark, feed, folder):
    marks = HighWater(spark, f"{folder}/marks", "j")
    with pytest.raises(Exception):
        ingest_history(feed.withColumn("payload", F.raise_error(F.lit("source went away"))), spec(folder), marks, date(2024, 2, 1))
    assert marks.load() is None
    assert ingest_history(feed, spec(folder), marks, date(2024, 2, 1)).read == 4


def test_marks_keep_microseconds_and_jobs_apart(spark, folder):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS at, 'x' AS s")
    marks = HighWater(spark, folder, "a")
    marks.commit(df.first(), df.schema)
    assert marks.load()["at"].microsecond == 123456
    assert HighWater(spark, folder, "b").load() is None
    later = df.withColumn("s", F.lit("y"))
    marks.commit(later.first(), df.schema)
    assert HighWater(spark, folder, "a").load()["s"] == "y"


def test_increments_compare_key_tuples(spark):
    df = spark.createDataFrame([(a, b) for a in (1, 2, 3) for b in (1, 2, 3)] + [(None, 1)], "a int, b int")
    mark = {"a": 2, "b": 2}
    beyond = sorted(tuple(r) for r in read_increment(df, ["a", "b"], mark).collect())
    assert beyond == [(2, 3), (3, 1), (3, 2), (3, 3)]
    assert read_up_to(df, ["a", "b"], mark).count() == df.count() - len(beyond)
    assert read_increment(df, ["a", "b"], None) is df


@pytest.mark.parametrize("n", [1, 2, 7])
def test_hash_slices_hold_every_row_once(spark, n):
    df = spark.range(-50, 50).select(F.when(F.col("id") % 9 != 0, F.col("id")).alias("k"))
    counts = [df.filter(p).count() for p in hash_predicates("k", n)]
    assert sum(counts) == df.count()
    with pytest.raises(ValueError):
        hash_predicates("k", 0)


def test_hash_of_another_dialect():
    assert hash_predicates("name", 2, "hashtext({field})") == [
        "MOD(hashtext(name), 2) = 0 OR name IS NULL",
        "MOD(hashtext(name), 2) IN (1, -1)",
    ]


class Database:
    """Records what is asked of the relational side, in place of a database."""

    def __init__(self, spark, monkeypatch):
        self.calls, self.written = [], None

        def write(writer, url, table, mode=None, properties=None):
            self.calls.append(("write", url, table, mode, properties))

        def read(reader, url, table, **kwargs):
            self.calls.append(("read", url, table, kwargs))
            return spark.createDataFrame([(7,)], "row_count bigint")

        monkeypatch.setattr(DataFrameWriter, "jdbc", write)
        monkeypatch.setattr(DataFrameReader, "jdbc", read)


@pytest.fixture
def database(spark, monkeypatch):
    return Database(spark, monkeypatch)


def test_relational_reads(spark, database):
    read_jdbc(spark, "u", "select * from t where a = 1;", {"user": "x"})
    read_jdbc(spark, "u", "s.t", bounds=("id", 0, 100, 4))
    read_jdbc_hashed(spark, "u", "s.t", "id", 2)
    plain, ranged, hashed = database.calls
    assert plain[2] == "(select * from t where a = 1) tmp" and plain[3]["properties"] == {"fetchsize": "10000", "user": "x"}
    assert ranged[2] == "s.t" and (ranged[3]["column"], ranged[3]["numPartitions"]) == ("id", 4)
    assert len(hashed[3]["predicates"]) == 2


def test_relational_writes(spark, database):
    df = spark.range(3)
    load_jdbc(df, "u", "t", batch_size=500, partitions=4, untyped_strings=True, properties={"user": "x"})
    assert database.calls[0][3:] == (
        "append",
        {"batchsize": "500", "isolationLevel": "READ_COMMITTED", "numPartitions": "4", "stringtype": "unspecified", "user": "x"},
    )
    assert reload_jdbc(df, "u", "t") and database.calls[1][3] == "overwrite"
    assert database.calls[1][4]["truncate"] == "true"
    assert not reload_jdbc(df.limit(0), "u", "t") and len(database.calls) == 2
    assert verify_load(spark, "u", "t") == 7
    assert database.calls[2][2] == "(select count(*) as row_count from t) tmp"
    assert write_options(isolation="NONE")["isolationLevel"] == "NONE"


def test_load_runs_only_with_input(spark, database, folder):
    load = LoadSpec(path=f"{folder}/in", schema="id INT, PayLoad STRING", sql="SELECT id, a FROM {input}", table="t", extract={"$.a": "a"})
    spark.createDataFrame([(1, {"a": "x"})], "id int, PayLoad map<string,string>").write.json(f"{folder}/in")
    assert load_history(spark, load, "u", partitions=2) == 7
    assert [c[0] for c in database.calls] == ["write", "read"]
    spark.range(0).write.mode("overwrite").json(f"{folder}/in")
    assert load_history(spark, load, "u") == 0 and len(database.calls) == 2


def test_audit_rows_carry_run_and_time(spark):
    df = spark.createDataFrame([("c", 1)], "ctrl string, n int")
    append_audit(df, "audit_rows", STAMP)
    append_audit(df.select("n", "ctrl"), "audit_rows", AuditStamp("r2", datetime(2024, 1, 1, 12)))
    got = sorted((r["ctrl"], r["n"], r["run_id"], str(r["run_time"])) for r in spark.table("audit_rows").collect())
    assert got == [("c", 1, "r1", "2024-07-01 08:00:00"), ("c", 1, "r2", "2024-01-01 07:00:00")]
    spark.sql("DROP TABLE audit_rows")


def test_rule_failures_are_appended(spark):
    failures = spark.createDataFrame([("rule", "{}", "a", "b", "c")], "rule_name string, record string, job_run_time string, job_run_time_est string, run_id string")
    append_failures(failures, "audit_failures", STAMP)
    assert spark.table("audit_failures").columns == ["rule_name", "record", "run_time", "run_id"]
    spark.sql("DROP TABLE audit_failures")


def test_repair_registers_new_directories(spark, folder):
    spark.sql(f"CREATE TABLE repaired (id BIGINT, d DATE) USING parquet PARTITIONED BY (d) LOCATION '{folder}/t'")
    spark.range(5).withColumn("d", F.lit("2024-01-01")).write.partitionBy("d").parquet(f"{folder}/t")
    assert spark.table("repaired").count() == 0
    repair_table(spark, "repaired")
    assert spark.table("repaired").count() == 5
    spark.sql("DROP TABLE repaired")


def test_batch_counts_while_writing(spark, folder):
    spark.sql(f"CREATE TABLE batch_out (id BIGINT) USING parquet LOCATION '{folder}/b'")
    batch = BatchSpec("SELECT id FROM {input} WHERE id >= :low", "INSERT INTO batch_out SELECT * FROM batch_output", params={"low": 3})
    assert run_batch(spark, batch, {"input": spark.range(10)}) == 7
    assert spark.table("batch_out").count() == 7
    assert run_batch(spark, BatchSpec("SELECT 1"), None) == 1
    spark.sql("DROP TABLE batch_out")


def test_sql_text_is_not_changed(spark):
    df = run_sql_step(spark, "SELECT 1 AS a -- first\n, 2 AS b", None)
    assert df.columns == ["a", "b"]
    spark.range(2).write.mode("overwrite").saveAsTable("step_input")
    assert run_sql_step(spark, "SELECT * FROM IDENTIFIER(:db || '.step_input')", {"db": "default"}).count() == 2
    spark.sql("DROP TABLE step_input")


def test_missing_records_are_exported_only_if_any(spark, folder):
    assert export_missing(spark.range(0), f"{folder}/none") == 0
    assert not glob.glob(f"{folder}/none")
    df = spark.createDataFrame([(1, 'say "hi", twice'), (2, None)], "id int, s string")
    assert export_missing(df, f"{folder}/some") == 2
    back = spark.read.schema(df.schema).csv(f"{folder}/some", header=True)
    assert sorted(map(tuple, back.collect())) == [(1, 'say "hi", twice'), (2, None)]


def test_quarantine_and_raw_append(spark, folder):
    for _ in range(2):
        quarantine(spark.range(2), f"{folder}/q")
        write_raw(spark.range(2), f"{folder}/r", ["d"], fixed_value="2024-01-01")
    assert spark.read.json(f"{folder}/q").count() == 4
    assert spark.read.json(f"{folder}/r").filter("d = '2024-01-01'").count() == 4
    write_raw(spark.range(1), f"{folder}/flat", [], compression="none")
    assert glob.glob(f"{folder}/flat/part-*.json")


def test_microseconds_survive_text_formats(spark, folder):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS n, TIMESTAMP '2024-01-01 00:00:00.654321' AS z")
    write_raw(df, folder, [])
    assert read_events(spark, folder, schema=df.schema).collect() == df.collect()


def test_counts_are_observed(spark):
    df, seen = counted(spark.range(10), top=F.max("id"))
    df.write.format("noop").mode("overwrite").save()
    assert isinstance(seen, Observation) and seen.get == {"rows": 10, "top": 9}


OLD = "id BIGINT NOT NULL, a STRUCT<x: INT, y: ARRAY<STRUCT<z: STRING>>>, gone STRING"
NEW = "id STRING NOT NULL, a STRUCT<x: INT, y: ARRAY<STRUCT<z: STRING, w: DATE>>>, m MAP<STRING, INT>"


def test_schema_diff(spark):
    got = {(r["path"], r["change"], r["old_type"], r["new_type"]) for r in schema_diff(spark, OLD, NEW).collect()}
    assert got == {
        ("id", "changed", "bigint", "string"),
        ("a.y[].w", "added", None, "date"),
        ("gone", "removed", "string", None),
        ("m", "added", None, "map"),
        ("m.key", "added", None, "string"),
        ("m.value", "added", None, "int"),
    }
    assert schema_diff(spark, OLD, OLD).isEmpty()
    loosened = schema_diff(spark, OLD, as_nullable(as_struct(OLD))).collect()
    assert [(r["path"], r["change"]) for r in loosened] == [("id", "changed")]


def test_registry_keeps_versions(spark, folder):
    registry, at = SchemaRegistry(spark, folder), datetime(2024, 1, 1)
    assert registry.latest("f") is None
    first = registry.reader_schema("f", as_struct(OLD), at)
    assert first == as_nullable(as_struct(OLD)) and first["id"].nullable
    registry.reader_schema("f", as_struct(OLD), at)
    assert registry.versions("f").count() == 2
    registry.reader_schema("f", as_struct(NEW), at)
    assert registry.latest("f", SchemaRegistry.OBSERVED) == as_struct(NEW)
    assert registry.versions("f").agg(F.max("version")).first()[0] == 2


def test_schema_of_payload_text(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": [1.5]}}',), ('{"a": "x", "d": true}',), ("broken",), (None,)], "p string")
    found = payload_schema(df, "p")
    assert isinstance(found, StructType) and set(found.names) == {"a", "b", "d"}
    assert found["d"].dataType.simpleString() == "boolean"
    with pytest.raises(ValueError):
        payload_schema(spark.createDataFrame([("[1]",)], "p string"), "p")


def test_schema_texts():
    assert as_struct("a INT") == as_struct(as_struct("a INT").json())


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_without_a_key_are_set_aside_and_never_lost(spark, folder):
    marks, schema = HighWater(spark, f"{folder}/marks", "j"), "at timestamp_ntz, id bigint, payload string"
    only = spark.createDataFrame([(None, None, '{"k": 1}'), (None, 5, '{"k": 2}')], schema)
    got = ingest_history(only, spec(folder), marks, date(2024, 2, 1))
    assert (got.read, got.written, got.unkeyed) == (2, 2, 0) and marks.load() is None
    more = only.unionAll(spark.createDataFrame([(datetime(2024, 1, 1), 1, '{"k": 3}'), (datetime(2024, 1, 1), 2, "bad")], schema))
    got = ingest_history(more, spec(folder), marks, date(2024, 2, 2))
    assert (got.read, got.written, got.quarantined, got.unkeyed) == (4, 3, 1, 0)
    last = more.unionAll(spark.createDataFrame([(datetime(2024, 1, 2), None, '{"k": 4}'), (datetime(2024, 1, 2), 1, '{"k": 5}')], schema))
    got = ingest_history(last, spec(folder), marks, date(2024, 2, 3))
    assert (got.read, got.written, got.unkeyed) == (1, 1, 3)
    assert spark.read.json(f"{folder}/err-unkeyed").count() == 3 and spark.read.json(f"{folder}/raw").count() == 4
    again = ingest_history(last, replace(spec(folder), set_aside_unkeyed=False), marks, date(2024, 2, 4))
    assert (again.read, again.unkeyed) == (0, 0)


def test_an_old_export_is_replaced(spark, folder):
    assert export_missing(spark.range(3), f"{folder}/export") == 3
    assert export_missing(spark.range(0), f"{folder}/export") == 0
    assert spark.read.schema("id long").csv(f"{folder}/export", header=True).count() == 0


def test_loading_nothing_from_nowhere(spark, folder):
    assert load_history(spark, LoadSpec(f"{folder}/absent", "a int", "SELECT * FROM {input}", "t"), "jdbc:none") == 0

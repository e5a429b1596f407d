"""Readers, writers, the suite, and where intermediate data goes."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadwitness import scratch
from loadwitness.operators.status import KEYWORDS
from loadwitness.plans.report import discrepancy_report, report_step
from loadwitness.plans.suite import run_suite, suite_verdicts
from loadwitness.sources import objects, quoted
from loadwitness.sources.metadata import jdbc_options, load_meta
from loadwitness.sources.objects import load_source, load_target
from loadwitness.sources.sinks import (
    export_discrepancies,
    export_discrepancy_ranges,
    load_discrepancies,
    load_results,
    replace_results,
    save_report,
    save_results,
)
from loadwitness.sources.specs import MappingSpec, specs_frame

LOGIN = {"user": "u", "password": "p"}


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "t", **LOGIN)["dbtable"] == "t"
    assert jdbc_options("jdbc:x", "SELECT 1 AS a", **LOGIN)["query"] == "SELECT 1 AS a"
    split = jdbc_options("jdbc:x", "SELECT a FROM t", partition_column="a", lower=0, upper=9, partitions=3, **LOGIN)
    assert "query" not in split and split["dbtable"] == "(SELECT a FROM t) AS part"
    assert (split["numPartitions"], split["partitionColumn"], split["upperBound"]) == ("3", "a", "9")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="a", **LOGIN)


def test_metadata_from_a_folder_or_the_catalog(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "runs.parquet"))
    assert load_meta(spark, "runs", str(tmp_path)).count() == 3
    spark.range(2).createOrReplaceTempView("runs_view")
    assert load_meta(spark, "runs_view").count() == 2


def test_csv_source(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day\n1,2024-01-01\nx,2024-01-02\n")
    plain = load_source(spark, str(tmp_path))
    assert [f.dataType for f in plain.schema.fields] == [T.StringType()] * 2
    schema = T.StructType().add("id", "integer").add("day", "date")
    typed = load_source(spark, str(tmp_path), schema=schema)
    assert len(schema.fields) == 2
    assert [r._corrupt_record for r in typed.collect()] == [None, "x,2024-01-02"]


def test_targets(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "t"))
    assert load_target(spark, str(tmp_path / "t"), "parquet").count() == 4
    spark.range(5).createOrReplaceTempView("target_view")
    assert load_target(spark, "target_view").count() == 5


def test_results_append(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.range(100).selectExpr("id % 7 AS batch_id", "'data' AS validation_type", "cast(id AS string) AS comment")
    save_results(df, path)
    save_results(df, path)
    assert spark.read.parquet(path).count() == 200


def test_results_saved_again_take_the_place_of_earlier_ones(spark, tmp_path):
    path = str(tmp_path / "results")
    schema = "mapping_id string, batch_id bigint, validation_type string, comment string"

    def results(*rows):
        return spark.createDataFrame([(m, b, "data", c) for m, b, c in rows], schema)

    def kept():
        rows = load_results(spark, path).collect()
        return sorted(((r.mapping_id, r.batch_id, r.comment) for r in rows), key=repr)

    first = [("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n"), ("a", None, "m")]
    replace_results(results(*first), path)
    replace_results(results(*first), path)
    assert kept() == sorted(first, key=repr)
    replace_results(results(("a", 1, "new"), (None, 1, "new"), ("c", 1, "added")), path)
    wanted = [("a", 1, "new"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "new"), ("a", None, "m"), ("c", 1, "added")]
    assert kept() == sorted(wanted, key=repr)
    # A load without any result now.
    replace_results(results(), path, loads=results(("b", 1, ""), ("a", None, "")))
    wanted = [w for w in wanted if w[:2] not in [("b", 1), ("a", None)]]
    assert kept() == sorted(wanted, key=repr)
    assert load_results(spark, path).columns == ["mapping_id", "batch_id", "validation_type", "comment"]
    with pytest.raises(ValueError):
        replace_results(spark.createDataFrame([("data", "x")], "validation_type string, comment string"), path)


def test_a_save_that_breaks_off_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "results")
    good = spark.range(10).selectExpr("id AS batch_id", "'data' AS validation_type", "'x' AS comment")
    replace_results(good, path)
    broken = good.selectExpr("batch_id", "validation_type", "raise_error('lost') AS comment")
    with pytest.raises(Exception, match="lost"):
        replace_results(broken, path)
    # Rows that came through before the manifest was written.
    good.withColumn("comment", F.lit("no")).write.parquet(f"{path}/results/save=s99999999999999999999-x")
    assert {r.comment for r in load_results(spark, path).collect()} == {"x"} and load_results(spark, path).count() == 10


def test_export_of_all_batches(spark, tmp_path):
    rows = [(1, 1, i, "present_only_in_source", f'a,"{i}"\nb') for i in range(11)] + [(2, 2, i, "other", "x") for i in range(11)]
    rows += [(3, 3, i, "present_only_in_source", "x") for i in range(10)]
    df = spark.createDataFrame(rows, "pipeline_id long, batch_id long, seq long, side string, payload string")
    export_discrepancies(df, str(tmp_path / "out"))
    read = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "out"))
    assert sorted(r.data_content for r in read.collect()) == sorted([f'a,"{i}"\nb' for i in range(11)] + ["x"] * 10)
    assert read.select("pipeline_id", "batch_id").distinct().count() == 2


def test_an_export_has_few_files(spark, tmp_path):
    df = spark.range(3000).selectExpr(
        "id % 40 AS pipeline_id", "id % 40 AS batch_id", "id AS seq", "'present_only_in_source' AS side", "'x' AS payload"
    )
    export_discrepancies(df, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").rglob("part-*.csv"))) <= 40 + 8


def test_an_export_in_ranges(spark, tmp_path):
    """Files by tasks whatever the number of batches; the index leads to those of one batch, and lost exports are not read."""
    path = str(tmp_path / "out")
    rows = spark.range(30_000).selectExpr(
        "id % 5000 AS pipeline_id", "id % 10000 AS batch_id", "id AS seq",
        "IF(id % 7 = 0, 'other', 'present_only_in_source') AS side", "concat('a,\"', id, '\"\nb') AS payload",
    )
    export_discrepancy_ranges(rows, path)
    assert len(list((tmp_path / "out" / "files").rglob("part-*.csv"))) <= 16
    found = load_discrepancies(spark, path)
    wanted = sorted((i % 5000, i % 10000, f'a,"{i}"\nb') for i in range(30_000) if i % 7)
    assert sorted((r.pipeline_id, r.batch_id, r.data_content) for r in found.collect()) == wanted
    one = load_discrepancies(spark, path, 17, 5017)
    assert sorted(r.data_content for r in one.collect()) == sorted(f'a,"{i}"\nb' for i in (5017, 15017, 25017) if i % 7)
    assert len(one.inputFiles()) < len(found.inputFiles()) or len(found.inputFiles()) == 1
    lost = rows.withColumn("payload", F.when(F.col("seq") < 29_000, "x").otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        export_discrepancy_ranges(lost, path)
    assert load_discrepancies(spark, path).count() == len(wanted)
    export_discrepancy_ranges(rows.limit(0), path)
    export_discrepancy_ranges(rows.where("seq = 1"), path)
    assert load_discrepancies(spark, path).count() == len(wanted) + 1
    assert load_discrepancies(spark, path, pipeline_id=-1).collect() == []


def test_reports_have_a_folder_per_batch(spark, tmp_path):
    df = spark.range(6).selectExpr("id % 2 AS dataflow_batch_id", "id AS pipeline_id", "id AS batch_id")
    save_report(df, str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").glob("dataflow*")) == ["dataflow_batch_id=0", "dataflow_batch_id=1"]


@pytest.mark.parametrize("suffix", ["csv", "parquet"])
def test_folders_are_made_and_read_by_tasks(spark, tmp_path, monkeypatch, suffix):
    """The driver neither lists the folders nor renames their files, which Spark's own writer and reader left to it."""
    from pyspark.sql import DataFrameWriter

    from loadwitness.sources.sinks import load_discrepancy_folders, load_reports

    def refused(self, *keys):
        raise AssertionError("folders by the driver")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refused)
    path = str(tmp_path / "out")
    if suffix == "csv":
        save, load, columns = export_discrepancies, load_discrepancy_folders, ["pipeline_id", "batch_id", "data_content"]
        rows = spark.range(3_000).selectExpr(
            "IF(id % 500 = 3, null, id % 500) AS pipeline_id", "id % 1000 AS batch_id", "id AS seq",
            "IF(id % 7 = 0, 'other', 'present_only_in_source') AS side",
            "CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('a,\"', id, '\"\n\rb') ELSE concat('x', id) END AS payload",
        )
        kept = rows.where("side <> 'other'").selectExpr("pipeline_id", "batch_id", "nullif(payload, '') AS data_content")
        folders = kept.select("pipeline_id", "batch_id").distinct().count()
    else:
        save, load, columns = save_report, load_reports, ["dataflow_batch_id", "pipeline_id", "batch_id", "text"]
        rows = kept = spark.range(3_000).selectExpr(
            "CASE id % 500 WHEN 3 THEN null WHEN 4 THEN 'a/b=c:%' WHEN 5 THEN '' ELSE cast(id % 500 AS string) END AS dataflow_batch_id",
            "id AS pipeline_id", "id AS batch_id", "IF(id % 3 = 0, null, 'x') AS text",
        )
        folders = 499
    wanted = sorted(map(repr, kept.select(*columns).collect()))
    save(rows, path)
    assert sorted(map(repr, load(spark, path).select(*columns).collect())) == wanted
    assert len({p.parent for p in (tmp_path / "out").rglob(f"*=*/part-*.{suffix}")}) == folders
    # A plain reader finds the same rows by the folders' names.
    plain = spark.read.options(header=True, escape='"', multiLine=True)
    plain = plain.csv(path) if suffix == "csv" else plain.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(path)
    assert plain.count() == len(wanted)
    # An export that breaks off changes nothing, another one adds its rows.
    with pytest.raises(Exception, match="lost"):
        save(rows.withColumn(rows.columns[-1], F.when(F.col("batch_id") < 900, "x").otherwise(F.raise_error(F.lit("lost")))), path)
    assert load(spark, path).count() == len(wanted)
    assert len(list((tmp_path / "out").rglob(f"*=*/part-*.{suffix}"))) == len(plain.inputFiles())
    save(rows.where("batch_id = 1"), path)
    assert load(spark, path).count() == len(wanted) + kept.where("batch_id = 1").count()
    save(rows.limit(0), path)
    assert load(spark, path).count() == len(wanted) + kept.where("batch_id = 1").count()


def test_suite_end_to_end(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text("id,email,day\n1,a,2024-01-01\n2,b,2024-01-02\n2,b,2024-01-02\n")
    spark.sql("SELECT 1 AS id, 'a' AS email, date'2024-01-01' AS day UNION ALL SELECT 2, null, date'2024-01-02'").write.parquet(
        str(tmp_path / "t")
    )
    good = MappingSpec(
        "m", 1, 1, str(tmp_path / "s"), str(tmp_path / "t"), target_format="parquet", uniqueness_columns=["id", "email"],
        not_null_columns=["id", "email"], compatible_types={"string": ["date", "timestamp", "int"]},
    )
    gone = MappingSpec("gone", 2, 2, str(tmp_path / "nowhere"), str(tmp_path / "t"), target_format="parquet")
    results = run_suite(spark, [good, gone])
    rows = [(r.mapping_id, r.validation_type, r.column_name, r.status) for r in results.collect()]
    assert ("gone", "suite", None, "error") in rows
    assert ("m", "row_count", None, "failed") in rows
    assert ("m", "not_null", "email", "failed") in rows and ("m", "not_null", "id", "passed") in rows
    assert sum(1 for r in rows if r[1] == "data") == 2
    judged = suite_verdicts(results, specs_frame(spark, [good, gone])).orderBy("mapping_id", "step_id").collect()
    assert [r.verdict for r in judged] == ["NA"] * 6 + ["NA", "Pass", "Fail", "Fail", "Pass", "Fail"]


@pytest.fixture
def loads(spark, tmp_path):
    """A clean and a broken load of one batch, the same batch number elsewhere, and one whose target cannot be read."""
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text("id,day\n1,2024-01-01\n2,2024-01-02\n")
    spark.sql("SELECT '1' AS id, '2024-01-01' AS day UNION ALL SELECT '2', '2024-01-02'").write.parquet(str(tmp_path / "t"))
    spark.sql("SELECT '1' AS id, '2024-01-01' AS day").write.parquet(str(tmp_path / "less"))
    spark.sql("SELECT '1' AS id, '2024-01-01' AS day").write.parquet(str(tmp_path / "torn"))
    for file in (tmp_path / "torn").glob("part-*"):
        file.write_bytes(file.read_bytes()[:-20] + b"x" * 20)
    schema = spark.read.parquet(str(tmp_path / "t")).schema

    def target(session, spec):
        return session.read.schema(schema).parquet(spec.target_object)

    def spec(name, pipeline, folder):
        return MappingSpec(name, pipeline, 7, str(tmp_path / "s"), str(tmp_path / folder), unique_keys=[["id", "day"]])

    specs = [spec("clean", 1, "t"), spec("broken", 1, "less"), spec("other", 2, "t"), spec("torn", 1, "torn")]
    return specs, run_suite(spark, specs, target_of=target)


def test_mappings_of_one_batch_are_judged_apart(spark, loads):
    specs, results = loads
    judged = suite_verdicts(results, specs_frame(spark, specs)).orderBy("step_id").collect()
    found = {s.mapping_id: [r.verdict for r in judged if r.mapping_id == s.mapping_id] for s in specs}
    assert found["clean"] == found["other"] == ["NA", "Pass", "Pass", "Pass", "Pass", "NA"]
    assert found["broken"] == ["NA", "Pass", "Fail", "Fail", "Pass", "NA"]
    assert found["torn"] == ["NA"] * 6
    shown = {r.execution_status for r in judged if r.mapping_id == "torn" and r.step_id > 1}
    assert shown == {"Fail"}


def test_an_unreadable_file_stays_with_its_mapping(loads):
    _, results = loads
    rows = results.collect()
    assert [(r.validation_type, r.status) for r in rows if r.mapping_id == "torn"] == [("suite", "error")]
    assert len({(r.mapping_id, r.seq) for r in rows}) == len(rows)
    assert any(r.comment.startswith("Column: id + day, Status: UNIQUE") for r in rows if r.comment)


def test_a_suite_goes_on_where_it_was_lost(spark, tmp_path):
    spark.sql("SELECT 1 AS id, 'a' AS t").write.parquet(str(tmp_path / "t"))
    specs = [MappingSpec(f"m{i}", 1, 7, "s", str(tmp_path / "t"), unique_keys=[["id"]]) for i in range(4)]
    specs += [MappingSpec("gone", 1, 7, "s", str(tmp_path / "nowhere")), specs[0]]
    read, lost = [], {"m2"}

    def source(session, spec):
        read.append(spec.mapping_id)
        if spec.mapping_id in lost:
            raise KeyboardInterrupt
        return session.sql("SELECT 1 AS id, 'a' AS t")

    def target(session, spec):
        return session.read.parquet(spec.target_object)

    name = f"lost-{tmp_path.name}"
    with pytest.raises(KeyboardInterrupt):
        run_suite(spark, specs, source, target, parallel=1, run=name)
    assert read[:3] == ["m0", "m1", "m2"]
    lost.clear()
    read.clear()
    results = run_suite(spark, specs, source, target, parallel=1, run=name)
    assert "m0" not in read[:-1] and "m1" not in read and "m2" in read
    whole = run_suite(spark, specs, source, target, parallel=2)
    shown = ["mapping_id", "validation_type", "status", "comment"]
    assert sorted(map(repr, results.select(*shown).collect())) == sorted(map(repr, whole.select(*shown).collect()))
    # All finished: only the mapping with an error is tried again. Another declaration is another mapping.
    read.clear()
    run_suite(spark, specs, source, target, parallel=1, run=name)
    assert read == ["gone"]
    changed = [MappingSpec("m0", 1, 7, "s", str(tmp_path / "t"), not_null_columns=["t"])]
    run_suite(spark, changed, source, target, run=name)
    assert read == ["gone", "m0"]


def test_saved_results_are_reported(spark, loads, tmp_path):
    specs, results = loads
    save_results(results, str(tmp_path / "saved"))
    saved = spark.read.parquet(str(tmp_path / "saved"))
    runs = specs_frame(spark, specs).selectExpr(
        "mapping_id", "pipeline_id", "batch_id", "1L AS dataflow_batch_id", "0L AS seq", "'SUCCESS' AS status",
        "'SUCCESS' AS ingestion_status", "'i' AS ingestion_name", "'p' AS pipeline_name",
    )
    clean = runs.where("mapping_id = 'other'").drop("mapping_id")
    steps = clean.select("pipeline_id", "batch_id").selectExpr("*", *[f"'Success' AS {k}" for k in KEYWORDS])
    own = saved.where("mapping_id = 'other'").drop("mapping_id", "pipeline_id")
    rows = report_step(clean, own, steps).orderBy("step_id").collect()
    assert [r.verdict for r in rows] == ["Pass", "Pass", "Pass", "Pass", "Pass", "NA"]
    assert discrepancy_report(clean, own, steps).count() == 0


def test_csv_as_sources_write_it(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"say ""hi"", now"\n2,"two\nlines"\n3,\n4,""\n')
    rows = load_source(spark, str(tmp_path)).orderBy("id").collect()
    assert [r.t for r in rows] == ['say "hi", now', "two\nlines", None, ""]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="share"):
        scratch.shared_dir(Session())


def quoted_file(path, rows, end="\n", header=True):
    import csv

    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=end)
        if header:
            writer.writerow(["id", "a,b", "t"])
        writer.writerows(rows)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def in_one_task(spark, path, schema=None):
    reader = spark.read.options(**objects.CSV_OPTIONS)
    return (reader if schema is None else reader.schema(schema)).csv(path)


def same_rows(a, b):
    assert a.columns == b.columns
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_are_read_by_several_tasks(spark, tmp_path, small_splits, end):
    """Breaks at any place of any split, values longer than several splits, doubled quotes next to breaks."""
    rng = random.Random(7)
    parts = [end, '"', ",", "x", 'say "hi"', "two" + end + "lines", "", " ", "é😀", end * 3]
    for n in range(3):
        rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 6))), rng.choice(["", "plain", None])) for i in range(200)]
        rows[50] = (50, ("long" + end) * 400, "x")
        rows[120] = (120, ('"' + end) * 500, "x")
        quoted_file(tmp_path / f"{n}.csv", rows, end)
    quoted_file(tmp_path / "plain.csv", [(i, "a", "b") for i in range(300)], end)
    found = objects.load_source(spark, str(tmp_path))
    lines = quoted._lines(spark, str(tmp_path))
    assert lines.select("file", "block").distinct().count() > 20
    assert lines.where("file LIKE '%plain.csv'").select(F.spark_partition_id()).distinct().count() > 1
    known = {(r["file"][-9:], r["block"]): r["busy"] for r in quoted.split_parities(lines).collect()}
    assert not any(busy for (file, _), busy in known.items() if file == "plain.csv") and any(known.values())
    assert found.count() == 900
    assert same_rows(found, in_one_task(spark, str(tmp_path)))


def test_split_files_that_fit_no_schema(spark, tmp_path, small_splits):
    text = 'id,d\n1,2024-01-01\n"2\n",2024-01-02\nx,2024-01-03\n3\n4,5,6\n\n"5",""\n6,"bad\ndate"\n' + "7,2024-02-02\n" * 100
    (tmp_path / "a.csv").write_text(text)
    schema = T.StructType.fromDDL(f"id int, d date, {objects.CORRUPT} string")
    reader = spark.read.options(**objects.CSV_OPTIONS).option("columnNameOfCorruptRecord", objects.CORRUPT).schema(schema)
    assert same_rows(objects.load_source(spark, str(tmp_path), schema="id int, d date"), reader.csv(str(tmp_path)))


def test_files_that_break_the_standard_and_other_options(spark, tmp_path, small_splits):
    quoted_file(tmp_path / "a.csv", [(i, "x\ny", "z") for i in range(60)])
    (tmp_path / "b.csv").write_text('id,"a,b",t\n1,5" pipe,x\n' + "2,y,z\n" * 60)
    assert same_rows(objects.load_source(spark, str(tmp_path)), in_one_task(spark, str(tmp_path)))
    assert not quoted.splits({**objects.CSV_OPTIONS, "encoding": "UTF-16"})
    assert not quoted.splits({**objects.CSV_OPTIONS, "escape": "\\"}) and not quoted.splits({**objects.CSV_OPTIONS, "mode": "DROPMALFORMED"})
    assert not quoted.splits({**objects.CSV_OPTIONS, "multiLine": "false"})
    assert objects.load_source(spark, str(tmp_path / "a.csv"), options={"multiLine": "false"}).count() == 120
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "e.csv").write_text("id,t\n")
    assert objects.load_source(spark, str(tmp_path / "e")).collect() == []
    quoted_file(tmp_path / "e" / "e.csv", [(1, "x\ny", "z")], header=False)
    headless = objects.load_source(spark, str(tmp_path / "e"), options={"header": "false"})
    assert [tuple(r) for r in headless.collect()] == [("1", "x\ny", "z")]

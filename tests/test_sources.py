import math
import os
from datetime import datetime

import pytest
from pyspark.sql import types as T

from panelweave import PanelSpec, workspace
from panelweave.operators import sequences, stats
from panelweave.plans import learn
from panelweave.sources import files
from panelweave.sources.schema import HOURLY_SCHEMA, LABEL, STATICS, VITALS_AND_LABS

SMALL = T.StructType(
    [T.StructField("HR", T.DoubleType()), T.StructField("Gender", T.IntegerType()), T.StructField("y", T.IntegerType())]
)


def write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_scan_of_entity_files(spark, tmp_path):
    write(tmp_path, "p000012.psv", "HR|Gender|y\nNaN|1|0\n81.5|1|1\n")
    write(tmp_path, "p100003.psv", "HR|Gender|y\n70|NaN|0\n")
    for name in (".p1.psv", "p2.PSV", "p3.txt"):
        write(tmp_path, name, "HR|Gender|y\n1|1|1\n")
    os.mkdir(tmp_path / "older")
    write(tmp_path / "older", "p4.psv", "HR|Gender|y\n1|1|1\n")
    df = files.read_panel_dir(spark, str(tmp_path), SMALL)
    assert df.columns == ["id", "HR", "Gender", "y"]
    rows = {tuple(r) for r in df.collect()}
    assert rows == {(12, None, 1, 0), (12, 81.5, 1, 1), (100003, 70.0, None, 0)}
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_reordered_header_fails(spark, tmp_path):
    write(tmp_path, "p1.psv", "Gender|HR|y\n1|80|0\n")
    with pytest.raises(Exception):
        files.read_panel_dir(spark, str(tmp_path), SMALL).collect()


def test_hourly_schema_has_the_public_columns(spark, tmp_path):
    names = HOURLY_SCHEMA.fieldNames()
    assert len(names) == 41 and names[0] == "HR" and names[-1] == LABEL
    assert names[7] == "EtCO2" and names[35] == "Gender" and names[34] == "Age"
    assert len(VITALS_AND_LABS) == 34 and len(STATICS) == 5
    write(tmp_path, "p7.psv", "|".join(names) + "\n" + "|".join(["NaN"] * 39 + ["3", "1"]) + "\n")
    row = files.read_panel_dir(spark, str(tmp_path), HOURLY_SCHEMA).first()
    assert (row.id, row.HR, row.ICULOS, row[LABEL]) == (7, None, 3, 1)


@pytest.mark.parametrize("group_rows", [None, 10])
def test_entity_folders_round_trip(spark, tmp_path, group_rows):
    rows = [(5, 1.5 * t if t % 3 else None, None, t) for t in range(40)] + [(6, 2.0, 0, 0)]
    df = spark.createDataFrame(rows, "id long, HR double, Gender int, y int")
    out = str(tmp_path / "out")
    files.write_panel_dir(df, PanelSpec("id", ("y",), ("HR",)), out, group_rows=group_rows)
    back = files.read_panel_dir(spark, out, SMALL, id_pattern=files.ENTITY_FOLDER)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    assert (len(os.listdir(os.path.join(out, "file=p5"))) > 2) == (group_rows is not None)


def test_entity_folders_are_placed_by_tasks_and_read_without_partitions(spark, tmp_path):
    rows = [(i, 1.5 * t, None, t) for i in range(40) for t in range(3)]
    df = spark.createDataFrame(rows, "id long, HR double, Gender int, y int")
    out, spec = str(tmp_path / "out"), PanelSpec("id", ("y",), ("HR",))
    files.write_panel_dir(df, spec, out)
    # Spark's writer leaves checksums, made and given their permissions one by one, and its driver renames each folder.
    found = [name for i in range(40) for name in os.listdir(os.path.join(out, f"file=p{i}"))]
    assert len(found) == 40 and all(n.endswith(".psv") for n in found) and "_SUCCESS" in os.listdir(out)
    # Folders that are no entity's are passed over.
    os.makedirs(os.path.join(out, "older", "deep"))
    write(os.path.join(out, "older"), "p4.psv", "HR|Gender|y\n1|1|1\n")
    write(os.path.join(out, "older", "deep"), "p4.psv", "HR|Gender|y\n1|1|1\n")
    write(out, "p5.psv", "HR|Gender|y\n1|1|1\n")
    back = files.read_panel_dir(spark, out, SMALL, id_pattern=files.ENTITY_FOLDER)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    # The driver's work for partition columns grows with the square of the folders.
    relation = back._jdf.queryExecution().analyzed().collectLeaves().head().relation()
    assert relation.partitionSchema().isEmpty()
    with pytest.raises(Exception):
        files.write_panel_dir(df, spec, out)
    none = str(tmp_path / "none")
    files.write_panel_dir(df.where("false"), spec, none)
    assert files.read_panel_dir(spark, none, SMALL, id_pattern=files.ENTITY_FOLDER).count() == 0


def test_entity_folders_hold_what_sparks_writer_puts_there(spark, tmp_path):
    texts = ["a|b", 'say "x"', "", None, " c ", "back\\slash"]
    rows = [("1/2", t, datetime(2024, 1, 2, 3, 4, 5, n), n) for n, t in enumerate(texts)] + [(None, "z", None, 9)]
    df = spark.createDataFrame(rows, "id string, `t|u` string, at timestamp, y int")
    out, spec = tmp_path / "out put", PanelSpec("id", ("y",), ("t|u",))
    files.write_panel_dir(df, spec, str(out))
    named = df.selectExpr("concat('p', id) AS file", "`t|u`", "at", "y")
    options = {"sep": "|", "header": True, "nullValue": "NaN", "timestampFormat": files.ISO_MICROS}
    named.coalesce(1).write.partitionBy("file").options(**options).csv(str(tmp_path / "plain"))

    def held(folder):
        found = [(p.parent.name, p.read_text().splitlines()) for p in folder.glob("file=*/part-*")]
        return sorted((name, lines[0], sorted(lines[1:])) for name, lines in found)

    assert held(out) == held(tmp_path / "plain")
    assert [name for name, _, _ in held(out)] == ["file=__HIVE_DEFAULT_PARTITION__", "file=p1%2F2"]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_panel_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([(5, 1.5, None, 0), (6, None, 0, 0)], "id long, HR double, Gender int, y int")
    path = str(tmp_path / fmt)
    files.write_panel(df, path, fmt)
    back = files.read_panel_csv(spark, path, df.schema) if fmt == "csv" else files.read_panel(spark, path)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    with pytest.raises(ValueError):
        files.write_panel(df, path, "xml")


def test_stats_and_sequences_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, t, float(t), t % 2) for t in range(16)], "id long, t long, a double, y int")
    fitted = stats.fit_stats(df, ["a"])
    files.save_stats(fitted, str(tmp_path / "stats"))
    assert files.load_stats(spark, str(tmp_path / "stats")).first() == fitted.first()
    packed = sequences.to_sequences(df, PanelSpec("id", ("t",), ("a",), "y"))
    files.write_sequences(packed, str(tmp_path / "seq"))
    assert files.read_sequences(spark, str(tmp_path / "seq")).first() == packed.first()


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    learn.log_run(spark, path, "a", {"epochs": 10}, {"f1": 0.5}, datetime(2024, 1, 1))
    learn.log_run(spark, path, "b", {"epochs": 20}, {"f1": 0.75})
    got = {r.run_id: (r.params["epochs"], r.metrics["f1"]) for r in learn.read_runs(spark, path).collect()}
    assert got == {"a": ("10", 0.5), "b": ("20", 0.75)}


def test_shared_dir_comes_from_the_session(spark):
    assert workspace.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    one = workspace.materialise(spark.range(5), "numbers")
    assert one.count() == 5 and workspace.fresh_path(spark, "x") != workspace.fresh_path(spark, "x")


def test_nan_in_parquet_becomes_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, None)], "id long, a double")
    df.write.parquet(str(tmp_path / "p"))
    back = files.read_panel(spark, str(tmp_path / "p"))
    assert {tuple(r) for r in back.collect()} == {(1, None), (2, 3.0), (3, None)}
    assert stats.fit_stats(back, ["a"]).first()["a__mean"] == 3.0


def test_predictions_are_lines_of_json(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"id":1,"result":[0]}'), (2, '{"id":2,"result":[1]}')], "id long, prediction string")
    files.write_predictions(df, str(tmp_path / "out"))
    back = spark.read.schema("id long, result array<int>").json(str(tmp_path / "out"))
    assert {(r.id, r.result[0]) for r in back.collect()} == {(1, 0), (2, 1)}


def test_a_cluster_must_name_the_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_dir(Cluster)


def test_flat_entity_files_round_trip(spark, tmp_path):
    rows = [(i, 1.5 * t if t % 3 else None, None, t) for i in (5, 6, 17) for t in range(9 + i)]
    df = spark.createDataFrame(rows, "id long, HR double, Gender int, y int")
    out = str(tmp_path / "flat")
    spec = PanelSpec("id", ("y",), ("HR",))
    # Written twice: files are replaced.
    assert [files.write_entity_files(df, spec, out) for _ in range(2)] == [3, 3]
    assert sorted(os.listdir(out)) == ["p17.psv", "p5.psv", "p6.psv"]
    lines = (tmp_path / "flat" / "p5.psv").read_text().splitlines()
    assert lines[:3] == ["HR|Gender|y", "NaN|NaN|0", "1.5|NaN|1"] and len(lines) == 15
    back = files.read_panel_dir(spark, out, SMALL)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert files.write_entity_files(df.where("false"), spec, str(tmp_path / "none")) == 0
    with pytest.raises(Exception):
        files.write_entity_files(df.withColumn("id", df.id * None), spec, str(tmp_path / "null"))

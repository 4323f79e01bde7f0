import pytest
from pyspark.sql import functions as F

from panelweave import PanelSpec
from panelweave.operators import evaluate, history, stats
from panelweave.plans import score
from panelweave.sources import folders
from panelweave.streaming import settling
from panelweave.streaming.alarms import fill_and_delay, held_back, score_rows
from registry.oracle import ORACLE
from registry.queries import drained_alarms, streamed_alarms
from tests.compare import connect, difference

SPEC = PanelSpec("id", ("ts", "k"), ("a", "b"))
SCHEMA = "id long, ts timestamp, k long, a double, b double"


def panel(spark, n=400):
    k = F.col("id")
    return spark.range(n).select(
        (k % 7).alias("id"), F.timestamp_seconds(1_700_000_000 + k * 60).alias("ts"), k.alias("k"),
        F.when(k % 3 == 0, k.cast("double")).alias("a"), F.when(k % 11 == 1, -k.cast("double")).alias("b"),
    )


def write_parts(df, folder, parts):
    """Consecutive files in order of arrival."""
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(str(folder))


def drain(spark, folder, tmp_path, make):
    arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    running = (
        make(arriving).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.parquet(out), progress


def alarms(ready, fitted):
    return score_rows(ready, SPEC, stats.stats_values(fitted), [2.0, -1.0], 0.1, 0.6)


IN_ORDER = ["k < 100", "k >= 100 AND k < 103", "k >= 103 AND k < 300", "k >= 300"]
SPREAD = [f"abs(hash(k)) % 4 = {i}" for i in range(4)]


@pytest.mark.parametrize("delay", [0, 5])
@pytest.mark.parametrize("parts, lateness", [(IN_ORDER, "1 second"), (IN_ORDER, "2 hours"), (SPREAD, "1 day")])
def test_drained_stream_equals_batch(spark, tmp_path, delay, parts, lateness):
    df = panel(spark)
    write_parts(df, tmp_path / "in", parts)
    fitted = stats.fit_stats(df, SPEC.features)
    got, progress = drain(spark, tmp_path / "in", tmp_path, lambda s: alarms(fill_and_delay(s, SPEC, delay, lateness), fitted))
    got = got.unionByName(alarms(held_back(spark, progress, df, SPEC, delay), fitted))
    trimmed = history.drop_last(history.ffill(df, SPEC), SPEC, delay)
    want = stats.impute_and_scale(trimmed, SPEC.features, fitted).withColumn(
        "score", score.linear_score(SPEC.features, [2.0, -1.0], 0.1)
    )
    want = want.select("id", "ts", "k", F.round("score", 9).alias("score"), evaluate.binarise("score", 0.6).alias("alarm"))
    got_rows = got.select("id", "ts", "k", F.round("score", 9).alias("score"), "alarm")
    assert got.count() == want.count() == 400 - 7 * delay
    assert want.exceptAll(got_rows).count() == 0
    assert got.where("late").count() == 0


def test_rows_leave_once_the_watermark_has_passed(spark, tmp_path):
    df = panel(spark)
    write_parts(df, tmp_path / "in", IN_ORDER)
    got, _ = drain(spark, tmp_path / "in", tmp_path, lambda s: fill_and_delay(s, SPEC, 0, "10 minutes"))
    assert 200 < got.count() < 400 and got.where("late").count() == 0


def test_late_rows_have_a_place_of_their_own(spark, tmp_path):
    df = panel(spark).where("id = 0")
    write_parts(df, tmp_path / "in", ["k >= 70 AND k < 140", "k < 70", "k >= 140"])
    got, progress = drain(spark, tmp_path / "in", tmp_path, lambda s: fill_and_delay(s, SPEC, 2, "1 second"))
    late = got.where("late")
    assert sorted(r.k for r in late.collect()) == sorted(r.k for r in df.where("k < 70").collect())
    rest = got.where("not late").unionByName(held_back(spark, progress, df, SPEC, 2))
    assert rest.agg(F.min("k")).first()[0] == 70
    assert rest.count() == df.count() - late.count() - 2


def test_repeated_rows_count_once(spark, tmp_path):
    df = panel(spark)
    write_parts(df.unionByName(df.where("k % 3 = 0")), tmp_path / "in", SPREAD)
    got, progress = drain(spark, tmp_path / "in", tmp_path, lambda s: fill_and_delay(s, SPEC, 0, "1 day"))
    assert got.unionByName(held_back(spark, progress, df, SPEC, 0)).count() == 400


def test_state_expires_after_the_watermark(spark, tmp_path):
    # Looking again must not keep a stream alive that stops when its input is read.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        expires(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def expires(spark, tmp_path):
    df = panel(spark)
    uneven = df.where("id = 0 AND k < 100").unionByName(df.where("id = 1 AND k >= 100"))
    write_parts(uneven, tmp_path / "in", IN_ORDER)
    got, progress = drain(spark, tmp_path / "in", tmp_path, lambda s: fill_and_delay(s, SPEC, 0, "1 minute", 1, 60_000))
    left = spark.read.format("statestore").load(progress).select("key.*").distinct()
    assert [r[0] for r in left.collect()] == [1]
    assert got.unionByName(held_back(spark, progress, df, SPEC, 0)).count() == uneven.count()


@pytest.mark.parametrize("files", [1, 4])
def test_query_reads_a_folder_in_any_order(spark, tmp_path, files):
    """The event table as a folder of files, spread by hash, one file for each micro-batch."""
    sf_dir = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = str(tmp_path / "events.parquet")
    events.repartition(files, F.hash("event_id")).write.parquet(folder)
    got = drained_alarms(spark, sf_dir, folder, maxFilesPerTrigger="1")
    assert difference(got, connect(sf_dir), ORACLE["stream_alarms_unordered"]) is None


# ---- state in tables


def settle(spark, df, tmp_path, parts, lateness, delay=5, **options):
    """A stream fed part after part, started anew for each."""
    made = settling.Settling(spark, str(tmp_path / "state"), df, SPEC, lateness, delay, **options)
    folder = tmp_path / "arrived"
    folder.mkdir()
    stream = spark.readStream.schema(SCHEMA).parquet(str(folder))
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(str(folder))
        made.start(stream).awaitTermination()
    return made


def rows_of(df):
    return sorted(tuple(r) for r in df.select("id", "ts", "k", "a", "b").collect())


@pytest.mark.parametrize("delay, lateness, parts", [(0, 600, IN_ORDER), (5, 600, IN_ORDER), (5, 86_400, SPREAD)])
def test_settled_rows_equal_batch(spark, tmp_path, delay, lateness, parts):
    df = panel(spark)
    made = settle(spark, df, tmp_path, parts, lateness, delay)
    out, rest = made.emitted(), made.remaining()
    assert rows_of(out.unionByName(rest)) == rows_of(history.drop_last(history.ffill(df, SPEC), SPEC, delay))
    assert out.where("late").count() == 0
    # Rows leave while the stream runs, unless all of them must wait.
    assert out.count() > 200 if lateness == 600 else out.count() == 0


def test_an_entity_with_most_rows_is_many_rows_of_state(spark, tmp_path):
    df = panel(spark).withColumn("id", F.when(F.col("id") < 4, 0).otherwise(F.col("id")))
    made = settle(spark, df, tmp_path, IN_ORDER, 600, 2, group_rows=20)
    want = history.drop_last(history.ffill(df, SPEC), SPEC, 2)
    assert rows_of(made.emitted().unionByName(made.remaining())) == rows_of(want)
    waiting = made._read(made._told(made._done()[-1])["waiting"], made._schema())
    assert waiting.where("id = 0").count() > 2


def test_null_entities_repeated_rows_and_rows_without_a_clock(spark, tmp_path):
    df = panel(spark, 60).withColumn("id", F.when(F.col("id") > 1, F.col("id")))
    odd = df.unionByName(df.where("k % 5 = 0")).unionByName(df.where("k = 7").withColumn("ts", F.lit(None).cast("timestamp")))
    made = settle(spark, odd, tmp_path, ["k < 30 or ts is null", "k >= 30"], 60, 1)
    assert rows_of(made.emitted().where("late").drop("ts").withColumn("ts", F.lit(0))) == rows_of(df.where("k = 7").withColumn("ts", F.lit(0)))
    got = made.emitted().where("not late").unionByName(made.remaining())
    assert got.count() == 60 - df.select("id").distinct().count()


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    df = panel(spark)
    made = settling.Settling(spark, str(tmp_path / "state"), df, SPEC, 600, 2)
    for i, part in enumerate(IN_ORDER):
        made.process(df.where(part), i)
        made.process(df.where(part), i)
    # The last batch fails after it has written, before it is named.
    folders.delete(spark, f"{tmp_path}/state/done/3")
    made.process(df.where(IN_ORDER[3]), 3)
    want = history.drop_last(history.ffill(df, SPEC), SPEC, 2)
    assert rows_of(made.emitted().unionByName(made.remaining())) == rows_of(want)


def test_kept_rows_become_one_table_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(settling, "COMPACT", 2)
    df = panel(spark)
    made = settling.Settling(spark, str(tmp_path / "state"), df, SPEC, 60, 2)
    for i in range(8):
        made.process(df.where(f"k >= {50 * i} and k < {50 * (i + 1)} and id <> {i % 3}"), i)
    kept = df.where("id <> floor(k / 50) % 3")
    want = history.drop_last(history.ffill(kept, SPEC), SPEC, 2)
    assert rows_of(made.emitted().unionByName(made.remaining())) == rows_of(want)
    assert len(made._told(7)["kept"]) <= 3


def test_query_lets_most_rows_leave_while_it_runs(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    made, _ = streamed_alarms(spark, sf_dir, str(tmp_path))
    out, rest = made.emitted(), made.remaining()
    assert out.where("not late").count() > rest.count()
    assert out.where("late").count() > 0


def test_an_empty_stream(spark, tmp_path):
    df = panel(spark).limit(0)
    made = settling.Settling(spark, str(tmp_path / "state"), df, SPEC, 60)
    assert made.emitted().count() == made.remaining().count() == 0
    made.process(df, 0)
    assert made.emitted().count() == made.remaining().count() == 0

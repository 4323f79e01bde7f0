import os
import subprocess
import sys
from pathlib import Path

from panelweave.workspace import materialise, scope


def test_intermediates_go_away_with_their_scope(spark):
    outside = materialise(spark.range(3), "outside")
    with scope():
        inside = materialise(spark.range(5), "inside")
        assert inside.count() == 5
        folder = inside.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert outside.count() == 3


def test_executors_get_the_package(tmp_path):
    """A session started elsewhere, whose workers find nothing of the library on their path."""
    root = Path(__file__).parent.parent
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
import __spark_entry__
print("rows", __spark_entry__.queries()["stream_alarms"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""
    clean = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]

import os
import subprocess
import sys

from heatline import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
print("rows", entry.queries()["kalman_velocity"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_find_the_package_from_any_folder(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(ELSEWHERE)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, str(script), ROOT], cwd=tmp_path, env=clean,
                         capture_output=True, text=True, timeout=180)
    assert "rows 3" in got.stdout, got.stderr[-2000:]


def test_settled_frames_are_read_from_the_shared_folder(spark):
    df = session.settle(spark.range(10))
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 10
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")


def test_spread_leaves_enough_splits_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores)
    assert session.spread(few, "id").rdd.getNumPartitions() == cores
    assert session.spread(many, "id") is many


def test_one_row_group_is_spread_whatever_its_splits(spark, tmp_path):
    """A file of one row group is cut into splits of which all but one are empty."""
    path, cores = str(tmp_path / "one"), spark.sparkContext.defaultParallelism
    spark.range(20_000).selectExpr("id", "sha2(string(id), 256) AS text").coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() > 2
        sizes = session.spread(df, "id").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert len(sizes) == cores and min(sizes) > 0
        assert session.spread(df, "id", per_core=session.scanned_bytes(df) // cores) is df
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_folders_are_dropped(spark, tmp_path):
    path = str(tmp_path / "gone")
    spark.range(3).write.parquet(path)
    session.drop_folder(spark, path)
    assert not os.path.exists(path)

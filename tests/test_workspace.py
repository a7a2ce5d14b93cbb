import os
import subprocess
import sys
import types

import pytest

from tidegate.workspace import exists, has_files, release, scratch_path, shared_dir


def session(master, **conf):
    return types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
        sparkContext=types.SimpleNamespace(master=master),
    )


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"


PLAIN_SESSION = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
from tidegate.workspace import shared_dir, stage
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert shared_dir(spark) == shared_dir(spark)
assert stage(spark.range(3), "x").df.count() == 3
print("staged")
"""


def test_a_plain_local_session_makes_its_own(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYSPARK_SUBMIT_ARGS": "pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", PLAIN_SESSION, root], env=env, capture_output=True, text=True, timeout=120)
    assert run.stdout.strip().endswith("staged"), run.stderr[-2000:]


def test_scratch_paths_differ_and_can_be_released(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and not exists(spark, one)
    spark.range(1).write.parquet(one)
    assert has_files(spark, one)
    release(spark, one, two)
    assert not exists(spark, one)

from types import SimpleNamespace

import pytest

from pairloom.session import scratch_path, stage, staging_dir


def fake(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder or default),
                           sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_the_named_folder_is_used():
    assert staging_dir(fake("spark://host:7077", "s3://bucket/checkpoints/")) == "s3://bucket/checkpoints"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_dir(fake("yarn"))


def test_a_local_session_gets_one_folder_of_its_own():
    assert staging_dir(fake("local[2]")) == staging_dir(fake("local[2]"))


def test_staged_rows_are_the_same(spark):
    df = spark.range(100).selectExpr("id", "array(cast(id as float)) as v")
    staged = stage(df)
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, staged.collect())) == sorted(map(str, df.collect()))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_a_session_made_elsewhere_gets_the_package(tmp_path):
    """From another folder and with plain settings, the Python workers must still find the package."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "import __spark_entry__ as driver\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('rows', driver.entry(spark).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=120)
    assert "rows 929" in done.stdout, done.stderr[-2000:]

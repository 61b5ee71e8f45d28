"""Folders of staged tables: one per run, gone at its end and not before."""

import os
import subprocess
import sys
import time

from headway import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_runs_tables_survive_expiry(spark):
    path = session.staging_folder(spark, "kept")
    spark.range(3).write.parquet(path)
    old = os.path.join(os.path.dirname(os.path.dirname(path.removeprefix("file:"))), "local-1-dead")
    os.makedirs(os.path.join(old, "table"))
    for folder in (os.path.join(old, "table"), old, path.removeprefix("file:"), session.run_folder(spark)):
        os.utime(folder, (1, 1))
    fresh = os.path.join(os.path.dirname(old), "local-2-alive")
    os.makedirs(fresh)
    assert session.expire_runs(spark, hours=48) == ["local-1-dead"]
    assert spark.read.parquet(path).count() == 3 and os.path.isdir(fresh) and not os.path.exists(old)
    os.rmdir(fresh)


def test_staging_scope(spark):
    outside = session.staging_folder(spark, "outside")
    with session.staging_scope(spark, "step"):
        inside = session.staging_folder(spark, "t")
        spark.range(2).write.parquet(inside)
        with session.staging_scope(spark, "part"):
            deep = session.staging_folder(spark, "t")
            spark.read.parquet(inside).write.parquet(deep)
        assert not os.path.exists(deep.removeprefix("file:")) and spark.read.parquet(inside).count() == 2
        spark.read.parquet(inside).write.parquet(outside)
    assert not os.path.exists(inside.removeprefix("file:"))
    assert spark.read.parquet(outside).count() == 2
    assert os.path.dirname(session.staging_folder(spark, "t")) == session.run_folder(spark)


def test_staged_tables_go_with_the_run(tmp_dir):
    code = ("from pyspark.sql import SparkSession\n"
            "from headway import session\n"
            "s = (SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
            f".config('spark.checkpoint.dir', {tmp_dir!r}).getOrCreate())\n"
            "p = session.staging_folder(s, 't')\n"
            "s.range(3).write.parquet(p)\n"
            "print('rows', s.read.parquet(p).count(), p)\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    line = next(x for x in done.stdout.splitlines() if x.startswith("rows 3 "))
    deadline = 50  # the JVM ends a moment after the interpreter
    while os.path.exists(os.path.dirname(line.split()[-1])) and deadline:
        time.sleep(0.2)
        deadline -= 1
    assert deadline and os.path.isdir(os.path.join(tmp_dir, "headway-staging"))

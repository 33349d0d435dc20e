"""Steps that run in Python workers, from a folder that does not hold the package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from civitally.operators import answers, vectors

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
sys.path.remove({repo!r})
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
for name in ("ets_forecast", "vector_topk"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_workers_need_no_package(tmp_path):
    repo = str(Path(__file__).resolve().parents[1])
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=repo, folder=str(tmp_path / "checkpoints")))
    empty = tmp_path / "empty"
    empty.mkdir()
    env = {"PATH": "/usr/bin:/bin", "PYSPARK_PYTHON": sys.executable, "JAVA_HOME": _java_home()}
    done = subprocess.run([sys.executable, str(script)], cwd=empty, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]


def _java_home():
    import os
    import shutil

    return os.environ.get("JAVA_HOME") or str(Path(shutil.which("java")).resolve().parents[1])


@pytest.mark.parametrize("text", [
    "DROP VIEW guarded", "CREATE TABLE made AS SELECT 1 AS x", "SELECT 1; DROP VIEW guarded",
    "INSERT INTO guarded VALUES (1)", "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`"])
def test_ad_hoc_refuses_commands(spark, text):
    spark.range(500).createOrReplaceTempView("guarded")
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR|UNSUPPORTED|TABLE_OR_VIEW_NOT_FOUND|PARSE"):
        answers.ad_hoc(spark, text).collect()
    assert spark.table("guarded").count() == 500
    assert not spark.catalog.tableExists("made")


@pytest.mark.parametrize("text, rows", [
    ("SELECT * FROM guarded", 200), ("SELECT * FROM guarded LIMIT 300;", 300), ("SELECT id FROM guarded -- all", 200),
    ("SELECT id FROM (SELECT * FROM guarded LIMIT 300)", 200), ("WITH g AS (SELECT * FROM guarded) SELECT * FROM g LIMIT 250", 250),
    ("SELECT * FROM guarded ORDER BY id DESC LIMIT 250 OFFSET 10", 250)])
def test_ad_hoc_limit(spark, text, rows):
    spark.range(500).createOrReplaceTempView("guarded")
    assert answers.ad_hoc(spark, text).count() == rows
    assert answers.ad_hoc(spark, text, limit=None).count() == (500 if rows == 200 and "300" not in text else 300 if "300" in text else rows)


def test_odd_vectors(spark):
    rows = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [1.0]), (None, [0.0, 0.0]), (5, [3.0, 4.0])],
        "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(9, [0.0, 0.0]), (8, None)], "query_id long, embedding array<double>")
    found = vectors.nearest_rows(rows, asked, k=3).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.distance) for r in found] == [(9, 1, 0.0), (9, 5, 25.0)]
    assert vectors.nearest_rows(rows.limit(0), asked).count() == 0

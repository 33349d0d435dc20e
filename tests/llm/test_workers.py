"""The operators' Python steps in workers that do not have the package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
sys.path.remove({repo!r})
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
for name in ("op1_pii_spans", "op5_chat_formatting", "op10_warc_archives", "op11_embedding_whitening", "op12_token_alignment",
             "op13_sharding", "pipeline"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_workers_need_no_package(tmp_path):
    import os
    import shutil

    repo = str(Path(__file__).resolve().parents[2])
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=repo, folder=str(tmp_path / "checkpoints")))
    empty = tmp_path / "empty"
    empty.mkdir()
    home = os.environ.get("JAVA_HOME") or str(Path(shutil.which("java")).resolve().parents[1])
    env = {"PATH": "/usr/bin:/bin", "PYSPARK_PYTHON": sys.executable, "JAVA_HOME": home}
    done = subprocess.run([sys.executable, str(script)], cwd=empty, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]

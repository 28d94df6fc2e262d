"""Tasks need no copy of the package: a session elsewhere, without a path to it, runs the queries."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
import __spark_entry__
for name, query in __spark_entry__.queries().items():
    if name.startswith("op") or name == "pipeline":
        assert query(spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_all_queries_from_another_folder(tmp_path):
    env = {"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}
    import os

    env |= {k: v for k, v in os.environ.items() if k.startswith(("JAVA", "SPARK", "LD_"))}
    env["PATH"] = os.environ["PATH"]
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(root=str(ROOT)), str(tmp_path / "shared")],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False,
    )
    assert "all ran" in done.stdout, done.stderr[-2000:]

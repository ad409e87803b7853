"""Executors need no installed copy of the package: all queries run from an empty folder, with the repository on the driver's path alone."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"
RUN = """
import sys
sys.path.append({repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
spark.range(1).mapInArrow(lambda batches: batches, "id long").collect()
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        print("ROWS", name, query(spark, {sf!r}).count(), flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_queries_on_bare_executors(tmp_path):
    repo = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(RUN.format(repo=repo, sf=SF))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    found = [line.split()[1:] for line in done.stdout.splitlines() if line.startswith("ROWS")]
    assert len(found) == 14 and all(int(n) > 0 for _, n in found), done.stderr[-3000:]

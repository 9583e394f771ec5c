"""Queries through the entry file, loaded by path from another folder: executors have no copy of the package."""

import os
import subprocess
import sys

import pytest

RUN = """
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").getOrCreate()
for name in sys.argv[3:]:
    print(name, entry.queries()[name](spark, sys.argv[2]).count(), flush=True)
"""


@pytest.mark.parametrize(
    "sf,names",
    [
        ("sf0.01", ["op2_packing", "pipeline"]),  # more than one shard
        ("sf0.001", ["op11_alignment", "op12_prefix_trie", "op13_language_model", "pair_scores", "als_topk_users_lists"]),
    ],
)
def test_queries_run_from_another_folder(tmp_path, sf, names):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "run.py"
    script.write_text(RUN)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), f"{repo}/__spark_entry__.py", f"/root/testdata/{sf}", *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    got = dict(line.split() for line in done.stdout.splitlines() if line.split()[0] in names)
    assert set(got) == set(names) and all(int(n) > 0 for n in got.values())

"""The operators run on workers that cannot import this package: their code travels with the job."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", sys.argv[2]).getOrCreate())

@F.udf("string")
def importable(x):
    try:
        import vitaspan
    except ImportError:
        return "no"
    return vitaspan.__file__

assert spark.range(1).select(importable("id")).head()[0] == "no"
sys.path.insert(0, sys.argv[1])
from __spark_entry__ import queries
for name, query in queries().items():
    if name.startswith("op"):
        print("rows", name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_workers_need_no_copy(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, str(tmp_path / "warehouse")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    counts = {line.split()[1]: int(line.split()[2]) for line in out.stdout.splitlines() if line.startswith("rows ")}
    assert len(counts) == 13 and all(n > 0 for n in counts.values())

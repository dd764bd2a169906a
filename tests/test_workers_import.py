"""Python tasks must find the package when the driver runs elsewhere
(the package is shipped with addPyFile); run in a fresh process from /tmp."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_train_sgd_from_another_working_directory(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]")
                 .config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        from cohortlens.operators import train_sgd
        df = spark.createDataFrame(
            [(i, float(i % 2), [(i % 3, 1.0)]) for i in range(20)],
            "sample_id long, y double, x array<struct<i:int,v:double>>")
        print("ROWS", train_sgd(df, 3, shards=2).count())
        spark.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=300)
    assert "ROWS 3" in out.stdout, out.stderr[-2000:]

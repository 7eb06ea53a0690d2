import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_workers_need_no_installed_package(tmp_path):
    """Every query runs where workers can't import the repository."""
    code = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {REPO!r})  # driver only; Python workers do not inherit it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        from lodestar.llm import QUERIES
        for name, (fn, _) in QUERIES.items():
            print("OK", name, fn(spark, "/root/testdata/sf0.001").count())
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert out.stdout.count("OK op") == 13, out.stderr[-2000:]

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_need_no_installed_package(tmp_path):
    """Arrow / pandas kernels run from a process whose workers cannot import the repo."""
    code = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {REPO!r})  # driver only; Python workers do not inherit it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        from lodestar import predict
        from lodestar.operators.canopy import local_canopies
        df = spark.createDataFrame([(i, [float(i), float(i % 3)]) for i in range(50)],
                                   "id bigint, features array<double>")
        a = predict(df, [[0.0, 0.0], [25.0, 1.0]], form="arrow").count()
        b = local_canopies(df, 5.0, buckets=2).count()
        print("OK", a, b)
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "OK 50" in out.stdout, out.stderr[-2000:]

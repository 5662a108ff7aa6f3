"""Task failures mid-job (as when an executor is lost): the quality writes
retry and still produce exactly the right rows, with nothing duplicated by
the failed attempt.  Runs in its own process with ``local[4,3]`` (a task
may be retried)."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from salesmart.functions.rules import Rule
    from salesmart.operators.quality import annotate
    from salesmart.plans.pipeline import write_checked
    from salesmart.settings import Settings
    from salesmart.sources.tables import create_zones

    spark = (SparkSession.builder.master("local[4,3]")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="salesmart-res-"))
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    marker_dir = tempfile.mkdtemp(prefix="salesmart-res-marker-")

    @F.udf(T.LongType())
    def flaky(x):
        import os
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 1 and x % 97 == 5:
            open(os.path.join(marker_dir, f"failed-stage{{ctx.stageId()}}"), "w").close()
            raise RuntimeError("injected task failure")
        return x

    df = spark.range(0, 4000, numPartitions=4).select(
        flaky("id").alias("k"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("v"))
    rules = [Rule("NOT_NULL", "v", "V_MISSING"), Rule("UNIQUE", "k", "K_DUP")]
    for mode in ("partitioned", "checkpoint"):
        s = Settings(prefix=f"res_{{mode}}_", materialize=mode)
        create_zones(spark, s)
        out = write_checked(annotate(df, rules), "orders", s)
        valid = spark.table(s.valid_table("orders"))
        assert (out["valid"], out["rejected"]) == (3600, 400), (mode, out)
        assert valid.count() == 3600 and valid.select("k").distinct().count() == 3600, mode
        assert spark.table(s.rejected_table("orders")).count() == 400, mode
    import os
    failures = os.listdir(marker_dir)
    assert failures, "no failure was injected"
    print("RESILIENT after", len(failures), "failed task attempts")
""")


def test_quality_writes_survive_task_failures():
    env = dict(os.environ, PYTHONPATH=ROOT)
    proc = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT)],
        capture_output=True, text=True, timeout=600, env=env,
    )
    assert "RESILIENT" in proc.stdout, proc.stdout[-2000:] + proc.stderr[-4000:]

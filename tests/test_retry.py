"""A task that dies mid-write is retried and the written run holds each row
once (J4, executor loss).  Runs in its own Spark process, since task retries
need a ``local[n, maxFailures]`` master."""

import os
import subprocess
import sys
import tempfile
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F, types as T
    from tidemark.operators.pageviews import trusted_transform
    from tidemark.session import build_session
    from tidemark.sinks.layers import write_trusted

    spark = build_session("local[4,3]", shuffle_partitions=4,
                          extra={{"spark.checkpoint.dir": {ckpt!r}}})

    @F.udf(T.LongType())
    def fail_first_attempt(v):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            raise RuntimeError("injected task failure")
        return v

    rows = [("2024-01-%02d" % (1 + i % 14), "d%d" % (i % 50), i) for i in range(2000)]
    raw = spark.createDataFrame(rows, "date string, domain string, pageviews bigint").repartition(4)
    raw = raw.withColumn("pageviews", fail_first_attempt("pageviews"))
    out = {out!r}
    write_trusted(trusted_transform(raw, "2024-01-15"), out)
    back = spark.read.parquet(out)
    want = trusted_transform(spark.createDataFrame(rows, "date string, domain string, pageviews bigint"), "2024-01-15")
    print("ROWS", back.count(), want.count(), back.distinct().count())
    """
)


def test_failed_task_is_retried_without_duplicates():
    tmp = tempfile.mkdtemp(prefix="tidemark-retry-")
    script = SCRIPT.format(repo=REPO, ckpt=f"{tmp}/ckpt", out=f"{tmp}/trusted")
    res = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    line = [l for l in res.stdout.splitlines() if l.startswith("ROWS")][0]
    got, want, distinct = map(int, line.split()[1:])
    assert got == want == distinct > 0
    assert "injected task failure" in res.stderr  # the failure did happen

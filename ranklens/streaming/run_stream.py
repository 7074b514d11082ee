"""Evaluate runs as they arrive: a file stream of run files scored micro-batch by micro-batch.

The evaluation tool scores one submitted run file per invocation; here the
submissions are a Structured Streaming source.  Each micro-batch holds whole
files (the text source never splits a file across batches), so every run in
it is complete and is evaluated with the same batch plan as
:func:`ranklens.plans.evaluate.evaluate`.  Results are written per epoch to
``<out>/epoch=<id>`` with overwrite, so a retried batch after a failure
replaces its own output (idempotent sink); progress lives in the checkpoint.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklens.plans.evaluate import evaluate
from ranklens.session import checkpoint_dir
from ranklens.sources.text_formats import _at_least


def parse_run_lines(lines: DataFrame) -> DataFrame:
    """Streaming-safe parse of ``qid iter docno rank sim run_id`` lines, like ``read_run``: malformed lines are errors."""
    f = F.split(F.regexp_replace(F.col("value"), r"^\s+|\s+$", ""), r"\s+")
    f = lines.select(f.alias("f")).where(F.col("f")[0] != "")
    return f.transform(_at_least(6)).select(
        F.col("f")[5].alias("run_id"), F.col("f")[0].alias("qid"), F.col("f")[2].alias("docno"), F.col("f")[4].cast("float").alias("sim")
    )


def evaluate_run_stream(
    spark: SparkSession,
    run_dir: str,
    qrels: DataFrame,
    out_path: str,
    measures="official",
    files_per_batch: int = 1,
    checkpoint: str | None = None,
    available_now: bool = True,
    **kwargs,
):
    """Start the stream; returns the StreamingQuery (``available_now`` drains what is there and stops)."""
    runs = parse_run_lines(spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(run_dir))
    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        scores = evaluate(batch, qrels, measures, **kwargs)
        scores.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")

    # a stream is known by what it reads and writes, so it goes on where it stopped and shares nothing with others
    known = hashlib.sha256(f"{run_dir}\n{out_path}".encode()).hexdigest()[:16]
    ck = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/run-stream-{known}"
    w = runs.writeStream.foreachBatch(score_batch).option("checkpointLocation", ck)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

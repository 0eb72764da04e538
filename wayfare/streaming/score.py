"""Stream scoring: stateless, so it needs no watermark and keeps no state."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wayfare.operators.validate import RequestRules
from wayfare.plans.serve import rejected_requests, score_requests, write_scored


def start_scoring(
    requests: DataFrame,
    out_path: str,
    checkpoint: str,
    model: PipelineModel | None = None,
    rules: RequestRules = RequestRules(),
    once: bool = True,
) -> StreamingQuery:
    """Write the scored rows of a request stream to Parquet.

    ``once`` drains what is there and stops; otherwise the query keeps running.
    The file sink commits each batch through its log, so a restart from the
    checkpoint neither loses nor repeats rows.
    """
    return _start(score_requests(requests, model, rules), out_path, checkpoint, once)


def start_quarantine(
    requests: DataFrame, out_path: str, checkpoint: str, rules: RequestRules = RequestRules(), once: bool = True
) -> StreamingQuery:
    """Write the rejected requests and their reasons, as a query of its own."""
    return _start(rejected_requests(requests, rules), out_path, checkpoint, once)


def start_serving(
    requests: DataFrame,
    out_path: str,
    rejected_path: str,
    checkpoint: str,
    model: PipelineModel | None = None,
    rules: RequestRules = RequestRules(),
    once: bool = True,
) -> StreamingQuery:
    """Score the accepted requests and quarantine the rest in one query that validates every request once.

    Each batch is written to a folder of its own under both paths, named by its id and replaced if the batch is run
    again. So a failure between the two writes neither loses nor repeats a request: the batch comes again
    with the same id and the same files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_scored(batch, f"{out_path}/batch={batch_id}", f"{rejected_path}/batch={batch_id}", model, rules)

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _start(df: DataFrame, out_path: str, checkpoint: str, once: bool) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)

"""Run metrics counted by the stream's own pass: observed values of each batch, kept as they come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Metrics(StreamingQueryListener):
    """What ``observed`` columns of the session's streams came to: ``rows`` of name, query, batch and values."""

    def __init__(self) -> None:
        self.rows: list[dict] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        for name, values in event.progress.observedMetrics.items():
            self.rows.append({"metric": name, "query": str(event.progress.id), "batch": event.progress.batchId, **values.asDict()})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def total(self, metric: str, value: str) -> int:
        """Over all batches, a batch that was run again counting once."""
        last = {(r["query"], r["batch"]): r[value] for r in self.rows if r["metric"] == metric}
        return sum(v or 0 for v in last.values())


def observed(df: DataFrame, name: str, **values: Column) -> DataFrame:
    """``df`` whose pass also counts ``values`` (aggregates) under ``name``."""
    return df.observe(name, *[c.alias(k) for k, c in values.items()])


def listen(spark: SparkSession) -> Metrics:
    found = Metrics()
    spark.streams.addListener(found)
    return found

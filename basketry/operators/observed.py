"""Quality metrics that a write or a stream takes along, instead of scans of their own.

``observe`` attaches aggregates to a table; Spark works them out while the rows pass by on their way to a sink. One scan
per table gives what the ``dq_`` checks of null keys, domains and freshness need a scan each for.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from basketry.schemas import DOMAINS, PRIMARY_KEYS

METRICS = "table_name string, metric string, value long"


def measures(
    table: str, df: DataFrame, time: str = "created_at", keys: Mapping[str, str] = PRIMARY_KEYS,
    domains: Mapping[tuple[str, str], Sequence[str]] = DOMAINS,
) -> list[Column]:
    """Rows, rows without key, values outside each domain (any case accepted) and the newest time in seconds."""
    found = [F.count(F.lit(1)).alias("rows")]
    if table in keys:
        found.append(F.count_if(F.col(keys[table]).isNull()).alias("null_keys"))
    found += [F.count_if(~F.lower(column).isin(*accepted)).alias(f"outside_{column}")
              for (owner, column), accepted in domains.items() if owner == table]
    if time in df.columns:
        found.append(F.max(F.unix_seconds(F.col(time).try_cast("timestamp"))).alias("newest_second"))
    return found


def write(tables: Mapping[str, DataFrame], sink: Callable[[str, DataFrame], None], **options) -> DataFrame:
    """Write every table through ``sink(name, df)``, which must run one action, and return the metrics of all.

    The metrics are those of the rows as written: table_name, metric, value.
    """
    rows, spark = [], None
    for name, df in tables.items():
        spark = df.sparkSession
        seen = Observation(f"quality of {name}")
        sink(name, df.observe(seen, *measures(name, df, **options)))
        rows += [(name, metric, value) for metric, value in seen.get.items()]
    return spark.createDataFrame(rows, METRICS)


def on_stream(stream: DataFrame, table: str, **options) -> DataFrame:
    """A stream that carries the metrics of each of its batches; ``StreamMetrics`` collects them."""
    return stream.observe(f"quality of {table}", *measures(table, stream, **options))


class StreamMetrics(StreamingQueryListener):
    """Collects what ``on_stream`` observes. Progress arrives apart from the query: ``wait`` for batches that count."""

    def __init__(self):
        self.rows: list[tuple] = []
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._news:
            for name, row in (progress.observedMetrics or {}).items():
                if name.startswith("quality of "):
                    self.rows += [(str(progress.id), progress.batchId, name[len("quality of "):], k, v) for k, v in row.asDict().items()]
            self._news.notify_all()

    def wait(self, query_id: str, batch: int, seconds: float = 30) -> None:
        """Until the batch of a query has been reported."""
        with self._news:
            if not self._news.wait_for(lambda: any(r[0] == str(query_id) and r[1] >= batch for r in self.rows), seconds):
                raise TimeoutError(f"no metrics of batch {batch}")

    def table(self, spark: SparkSession) -> DataFrame:
        """query_id, batch, table_name, metric, value. A batch that ran again is reported once more, with equal values."""
        with self._news:
            rows = list(dict.fromkeys(self.rows))
        return spark.createDataFrame(rows, f"query_id string, batch long, {METRICS}")

"""Alerts sent one by one from the tasks that hold them: repeated attempts, and a file for each alert that could not be sent.

A sink is made in every task by a function that the caller gives, so any client of a message broker can stand behind it. What became of each alert is
written once and read from there, so asking for counts and failures sends nothing again. A task that is run again sends its alerts again: receivers may
see an alert twice, never less than once, and know it by its key.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize, release
from .alerts import messages


class Sink(Protocol):
    """Where alerts go. ``send`` raises if one can't be taken; ``close`` may raise for what was taken but not delivered."""

    def send(self, key: bytes, value: bytes, headers: list[tuple[str, bytes]]) -> None: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class Delivery:
    """How alerts are sent: ``sink`` makes one for a task, ``topics`` (asked once, on the driver) names what the broker has."""

    sink: Callable[[], Sink]
    schema_id: int = 0
    failures: str | None = None
    attempts: int = 3
    pause: float = 0.2
    topic: str | None = None
    topics: Callable[[], Iterable[str]] | None = None


OUTCOME = "key binary, sent boolean, attempts int, error string, value binary"


def require_topic(delivery: Delivery) -> None:
    """A topic that the broker does not have, or a broker that does not answer, is an error before anything is sent."""
    if delivery.topics is None:
        return
    try:
        known = set(delivery.topics())
    except Exception as error:
        raise RuntimeError(f"the broker does not answer: {error}") from error
    if delivery.topic not in known:
        raise ValueError(f"the broker has no topic {delivery.topic}")


def _send_all(delivery: Delivery) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink: Sink | None = None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                headers = [(h["key"], bytes(h["value"])) for h in row["headers"]]
                error = None
                for attempt in range(1, delivery.attempts + 1):
                    try:
                        sink = delivery.sink() if sink is None else sink
                        sink.send(bytes(row["key"]), bytes(row["value"]), headers)
                        error = None
                        break
                    except Exception as failed:
                        error = f"{type(failed).__name__}: {failed}"
                        if attempt < delivery.attempts:
                            time.sleep(delivery.pause * attempt)
                out.append((row["key"], error is None, attempt, error, None if error is None else row["value"]))
            types = (pa.binary(), pa.bool_(), pa.int32(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types], names=["key", "sent", "attempts", "error", "value"])
        if sink is not None:
            sink.close()

    return run


def deliver(alerts: DataFrame, delivery: Delivery) -> dict[str, int]:
    """Send all alerts; numAlertsSent, numAlertsFailed and numAlertsRetried (sent, but not at once).

    A failed alert lies under ``failures`` in a folder of its own (``diaSourceId=...``) with its message and the last error; a later failure of the same
    alert replaces it. Without ``failures`` a failed alert is an error, after all others were sent.
    """
    require_topic(delivery)
    outcome = materialize(messages(alerts, delivery.schema_id).mapInArrow(_send_all(delivery), OUTCOME), "outcome")
    sent = F.col("sent")
    counted = outcome.agg(F.count(F.when(sent, 1)), F.count(F.when(~sent, 1)), F.count(F.when(sent & (F.col("attempts") > 1), 1)), F.min(F.when(~sent, F.col("error")))).first()
    if counted[1] and delivery.failures is None:
        raise RuntimeError(f"{counted[1]} alerts could not be sent: {counted[3]}")
    if counted[1]:
        failed = outcome.where(~sent).select(F.col("key").cast("string").cast("long").alias("diaSourceId"), "value", "error", "attempts")
        failed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("diaSourceId").parquet(delivery.failures)
    release(outcome)
    return {"numAlertsSent": counted[0], "numAlertsFailed": counted[1], "numAlertsRetried": counted[2]}


def failed_alerts(spark, path: str) -> DataFrame:
    """diaSourceId, value (the message as it should have been sent), error and attempts of the alerts that lie under ``path``."""
    return spark.read.schema("value binary, error string, attempts int, diaSourceId long").parquet(path)


def send_again(spark, path: str, delivery: Delivery) -> dict[str, int]:
    """Send the failed alerts under ``path``; those that fail again go to ``delivery.failures``, which must be another folder."""
    if delivery.failures == path:
        raise ValueError("alerts that fail again need a folder of their own")
    stamp = F.array(F.struct(F.lit("producer_timestamp").alias("key"), F.unix_millis(F.current_timestamp()).cast("string").cast("binary").alias("value")))
    again = failed_alerts(spark, path).select(F.col("diaSourceId").cast("string").cast("binary").alias("key"), "value", stamp.alias("headers"))
    outcome = materialize(again.mapInArrow(_send_all(delivery), OUTCOME), "outcome")
    sent = outcome.where("sent").count()
    failed = outcome.where("not sent").select(F.col("key").cast("string").cast("long").alias("diaSourceId"), "value", "error", "attempts")
    n = failed.count()
    if n and delivery.failures is not None:
        failed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("diaSourceId").parquet(delivery.failures)
    release(outcome)
    return {"numAlertsSent": sent, "numAlertsFailed": n}

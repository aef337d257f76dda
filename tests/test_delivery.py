"""Alerts one by one: attempts, dead letters, counts, topics."""

import os

import pytest
from pyspark.sql import functions as F

from skymatch.operators import delivery


def sink_in(path, bad=(), shy=()):
    """A sink that takes an alert as a file; ids in ``bad`` never, ids in ``shy`` at the second attempt."""
    os.makedirs(path, exist_ok=True)

    class FileSink:  # within, so that it travels to the tasks by value
        def __init__(self):
            self.tried = set()

        def send(self, key, value, headers):
            number = int(key)
            if number in bad:
                raise ConnectionError(f"no {number}")
            if number in shy and number not in self.tried:
                self.tried.add(number)
                raise TimeoutError("later")
            with open(f"{path}/{number}", "wb") as f:
                f.write(value)

        def close(self):
            pass

    return FileSink


@pytest.fixture
def alerts(spark):
    return spark.range(1, 41, numPartitions=3).select(F.col("id").alias("diaSourceId"), F.lit("text").alias("note"))


def test_failed_alerts_lie_in_files_and_the_rest_is_sent(spark, alerts, tmp_path):
    sent, failures = str(tmp_path / "sent"), str(tmp_path / "failures")
    bad, shy = [3, 17, 40], [4, 5]
    how = delivery.Delivery(sink_in(sent, bad=bad, shy=shy), 703, failures, attempts=2, pause=0.0)
    assert delivery.deliver(alerts, how) == {"numAlertsSent": 37, "numAlertsFailed": 3, "numAlertsRetried": 2}
    assert sorted(map(int, os.listdir(sent))) == [i for i in range(1, 41) if i not in bad]
    assert sorted(d for d in os.listdir(failures) if d.startswith("dia")) == sorted(f"diaSourceId={i}" for i in bad)
    rows = {r.diaSourceId: r for r in delivery.failed_alerts(spark, failures).collect()}
    assert sorted(rows) == bad and rows[3].error == "ConnectionError: no 3" and rows[3].attempts == 2
    assert bytes(rows[3].value[:5]) == b"\x00\x00\x00\x02\xbf"
    with open(f"{sent}/1", "rb") as f:
        assert f.read()[:5] == b"\x00\x00\x00\x02\xbf"
    assert delivery.deliver(alerts, how)["numAlertsFailed"] == 3  # a repeated failure replaces its file
    assert delivery.failed_alerts(spark, failures).count() == 3
    assert delivery.send_again(spark, failures, delivery.Delivery(sink_in(sent, bad=[17]), failures=str(tmp_path / "again"), attempts=1)) == {"numAlertsSent": 2, "numAlertsFailed": 1}
    assert [r.diaSourceId for r in delivery.failed_alerts(spark, str(tmp_path / "again")).collect()] == [17]
    with pytest.raises(ValueError):
        delivery.send_again(spark, failures, how)


def test_without_a_folder_failures_are_an_error(alerts, tmp_path):
    sent = str(tmp_path / "sent")
    with pytest.raises(RuntimeError, match="1 alerts could not be sent: ConnectionError: no 8"):
        delivery.deliver(alerts, delivery.Delivery(sink_in(sent, bad=[8]), attempts=1))
    assert len(os.listdir(sent)) == 39


def test_a_sink_that_cannot_be_made_fails_its_alerts(spark, alerts, tmp_path):
    def none():
        raise OSError("no broker")

    got = delivery.deliver(alerts, delivery.Delivery(none, failures=str(tmp_path / "f"), attempts=1))
    assert got == {"numAlertsSent": 0, "numAlertsFailed": 40, "numAlertsRetried": 0}
    assert delivery.deliver(alerts.limit(0), delivery.Delivery(none, failures=str(tmp_path / "f"))) == {"numAlertsSent": 0, "numAlertsFailed": 0, "numAlertsRetried": 0}


def test_topics(alerts, tmp_path):
    make = sink_in(str(tmp_path / "sent"))
    with pytest.raises(ValueError, match="no topic x"):
        delivery.deliver(alerts, delivery.Delivery(make, topic="x", topics=lambda: ["alerts"]))

    def silent():
        raise TimeoutError("15 s")

    with pytest.raises(RuntimeError, match="does not answer: 15 s"):
        delivery.deliver(alerts, delivery.Delivery(make, topic="x", topics=silent))
    assert os.listdir(tmp_path / "sent") == []
    assert delivery.deliver(alerts, delivery.Delivery(make, topic="alerts", topics=lambda: ["alerts"]))["numAlertsSent"] == 40

"""Alert files: bytes taken apart by hand, splits, odd rows, and reading as a table."""

import hashlib
import json
import os
import zlib

import pytest
from pyspark.sql import functions as F

from skymatch.operators.alerts import avro_schema, decode_avro
from skymatch.sources import containers

SOURCE = "struct<visit: bigint, detector: bigint, flux: double, name: string>"
ALERT = f"diaSourceId bigint, diaSource {SOURCE}, history array<struct<mjd: double, n: int>>, stamp binary, good boolean"


def rows(n=60):
    out = []
    for i in range(n):
        history = None if i % 5 == 0 else [(60000.0 + j, j) for j in range(i % 4)]
        out.append((i, (1 + i % 3, i % 2, i / 7, f"n{i}ü" if i % 2 else None), history, bytes(range(i)), i % 2 == 0 if i % 7 else None))
    return out


@pytest.fixture
def alerts(spark):
    return spark.createDataFrame(rows(), ALERT).repartition(3)


def take_apart(data):
    """Schema, codec and blocks (count, bytes) of a container, read by other code than the library's."""
    at = 4
    assert data[:4] == b"Obj\x01"

    def number():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n += (b & 127) << shift
            shift += 7
            if not b & 128:
                return n // 2 if n % 2 == 0 else -(n + 1) // 2

    def piece(n):
        nonlocal at
        at += n
        return data[at - n : at]

    meta = {}
    for _ in range(number()):
        key = piece(number())
        meta[key] = piece(number())
    assert number() == 0
    marker, blocks = piece(16), []
    while at < len(data):
        n = number()
        body = piece(number())
        assert piece(16) == marker
        blocks.append((n, zlib.decompress(body, -15) if meta[b"avro.codec"] == b"deflate" else body))
    return json.loads(meta[b"avro.schema"]), meta[b"avro.codec"].decode(), marker, blocks


def plain(row):
    return json.loads(json.dumps(row.asDict(True), default=lambda b: bytes(b).hex()))


@pytest.mark.parametrize("codec", containers.CODECS)
def test_files_of_a_visit_and_detector(spark, alerts, tmp_path, monkeypatch, codec):
    folder = str(tmp_path / "files")
    made = {r.file: r for r in containers.write_alert_files(alerts, folder, codec).collect()}
    assert sorted(os.listdir(folder)) == sorted(made) == [f"{v}_{d}.avro" for v in (1, 2, 3) for d in (0, 1)]
    want = {r.diaSourceId: plain(r) for r in alerts.collect()}
    seen = []
    for file, r in made.items():
        with open(f"{folder}/{file}", "rb") as f:
            data = f.read()
        schema, used, marker, blocks = take_apart(data)
        assert used == codec and schema == json.loads(json.dumps(avro_schema(alerts.schema))) and r.bytes == len(data)
        assert marker == hashlib.md5(file.encode()).digest() and r.alerts == sum(n for n, _ in blocks)
        for n, body in blocks:
            at = 0
            for _ in range(n):
                alert, at = decode_avro(alerts.schema, body, at)
                alert["stamp"] = alert["stamp"].hex()
                assert alert == want[alert["diaSourceId"]] and (r.visit, r.detector) == (alert["diaSource"]["visit"], alert["diaSource"]["detector"])
                seen.append(alert["diaSourceId"])
            assert at == len(body)
    assert sorted(seen) == sorted(want)
    back = containers.read_alert_files(spark, folder)
    assert {r.diaSourceId: plain(r) for r in back.collect()} == want and back.count() == len(want)
    before = {f: open(f"{folder}/{f}", "rb").read() for f in made}
    containers.write_alert_files(alerts.repartition(5), folder, codec)
    assert {f: open(f"{folder}/{f}", "rb").read() for f in os.listdir(folder)} == before


def test_small_blocks_split_anywhere(spark, alerts, tmp_path):
    """One block a record, and parts of files far smaller and a little larger than a block."""
    file = str(tmp_path / "1_1.avro")
    marker = b"0123456789abcdef"
    bodies = {r.diaSourceId: bytes(r.body) for r in containers.avro_bodies(alerts).collect()}
    with open(file, "wb") as f:
        f.write(containers.header(alerts.schema, "null", marker) + b"".join(containers.block([bodies[i]], "null", marker) for i in sorted(bodies)))
    reader = containers.AlertSource({"path": str(tmp_path)})
    for split in (7, 16, 17, 100, 333, os.path.getsize(file), 1 << 20):
        parts = containers._AlertReader(str(tmp_path), split, reader.schema()).partitions()
        assert len(parts) == -(-os.path.getsize(file) // split)
        found = [record[0] for part in parts for record in containers._AlertReader(str(tmp_path), split, alerts.schema).read(part)]
        assert found == sorted(bodies)
    assert containers.read_alert_files(spark, str(tmp_path), split_bytes=500).select(F.sum("diaSourceId")).first()[0] == sum(bodies)


def test_crowded_null_and_repeated_rows(spark, tmp_path):
    more = [(i, (7, 3, 1.0, None), None, None, None) for i in range(50)] + [(9, (7, 3, 1.0, None), None, None, None), (100, (None, None, None, None), [None], b"", True), (101, None, [], None, False)]
    alerts = spark.createDataFrame(more, ALERT)
    made = {r.file: r.alerts for r in containers.write_alert_files(alerts, str(tmp_path / "a"), most_rows=20).collect()}
    assert set(made) == {"7_3.avro", "7_3_1.avro", "7_3_2.avro", "null_null.avro"} and made["null_null.avro"] == 2 and sum(made.values()) == 53
    back = containers.read_alert_files(spark, str(tmp_path / "a"))
    assert sorted(map(str, map(plain, back.collect()))) == sorted(map(str, map(plain, alerts.collect())))


def test_nothing_to_write_and_what_is_no_container(spark, alerts, tmp_path):
    assert containers.write_alert_files(alerts.limit(0), str(tmp_path / "none")).count() == 0
    assert containers.read_alert_files(spark, str(tmp_path / "none"), alerts.schema).count() == 0
    with pytest.raises(Exception, match="no alert files"):
        containers.read_alert_files(spark, str(tmp_path / "none")).count()
    with pytest.raises(ValueError, match="codec"):
        containers.write_alert_files(alerts, str(tmp_path / "x"), "snappy")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "1_1.avro").write_bytes(b"PAR1 and more")
    with pytest.raises(Exception, match="not an Avro container"):
        containers.read_alert_files(spark, str(tmp_path / "bad"), alerts.schema).collect()
    containers.write_alert_files(alerts.where("diaSource.visit = 1 and diaSource.detector = 1"), str(tmp_path / "cut"))
    with open(tmp_path / "cut" / "1_1.avro", "r+b") as f:
        f.truncate(os.path.getsize(f.name) - 20)
    with pytest.raises(Exception, match="ends within a block"):
        containers.read_alert_files(spark, str(tmp_path / "cut"), alerts.schema).collect()

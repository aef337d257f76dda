"""Crowded images and visits are worked on in parts."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skymatch.operators import alerts, assign, forced
from skymatch.operators.crossmatch import MatchConfig
from skymatch.sources import containers


def test_a_crowded_image_is_dealt_in_parts_with_a_copy_each(spark):
    at = spark.range(3000).select(F.lit(1).cast("long").alias("visit"), F.when(F.col("id") >= 10, 2).cast("int").alias("detector"), "id")
    images = spark.createDataFrame([(1, 2, [1.0]), (1, None, [2.0]), (9, 2, [3.0])], "visit bigint, detector int, pixels array<double>")

    def run(key, where, image):
        return pd.DataFrame({"n": [len(where)], "images": [len(image)], "pixel": [float(image["pixels"].iloc[0][0])]})

    got = forced.with_images(at, images, most=100).applyInPandas(run, "n long, images long, pixel double").collect()
    assert max(r.n for r in got) < 200 and {r.images for r in got} == {1}
    assert sum(r.n for r in got if r.pixel == 1.0) == 2990 and [r.n for r in got if r.pixel == 2.0] == [10] and len(got) == 31


def test_no_list_of_an_alert_is_shuffled_after_it_was_attached(spark):
    sources = spark.range(6).select(F.col("id").alias("diaSourceId"), (F.col("id") % 3).alias("diaObjectId"), F.lit(1.0).alias("midpointMjdTai"))
    objects = spark.range(1, 3).select(F.col("id").alias("diaObjectId"), F.lit(2).cast("long").alias("nDiaSources"))
    past = sources.where("diaObjectId <> 0")
    fluxes = past.select("diaObjectId", F.col("diaSourceId").alias("diaForcedSourceId"), "midpointMjdTai")
    solar = sources.where("diaObjectId = 0").select("diaSourceId", F.lit(5).cast("long").alias("ssObjectId"))
    made = alerts.assemble(sources, objects, past, fluxes, solar, stamps=sources.select("diaSourceId", *[F.lit(b"x").alias(c) for c in ("cutoutDifference", "cutoutScience", "cutoutTemplate")]))
    joins = [line for line in made._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line]
    assert len(joins) == 5 and all("diaSourceId#" not in line.split("Join")[1].split("=")[0] for line in joins[:3]) and all("diaSourceId#" in line for line in joins[3:])
    got = {r.diaSourceId: r for r in made.collect()}
    assert [len(got[i].prvDiaSources or []) for i in range(6)] == [0, 2, 2, 0, 2, 2] and got[3].ssSource.ssObjectId == 5 and got[1].ssSource is None and bytes(got[5].cutoutScience) == b"x"
    assert [len(got[i].prvDiaForcedSources) for i in range(6)] == [0, 2, 2, 0, 2, 2] and got[0].diaObject is None


@pytest.mark.parametrize("codec", containers.CODECS)
def test_large_lists_are_compressed_once_and_passed_over(spark, tmp_path, monkeypatch, codec):
    kind = "diaSourceId bigint, diaSource struct<visit: bigint, detector: bigint>, long array<struct<mjd: double, n: int>>, name string"
    most = [(i / 7, i) for i in range(6000)]
    rows = [(i, (1, 2), [most, None, [(1.0, 2)], most[::-1]][i % 4], f"n{i}") for i in range(20)]
    made = spark.createDataFrame(rows, kind)
    packed = containers._encoded(made, {"_visit": F.col("diaSource.visit")}, codec)
    sizes = packed.agg(F.sum("size"), F.sum(F.length("body"))).first()
    assert {r.packed for r in packed.collect()} == ({True, False} if codec == "deflate" else {False}) and (sizes[1] < sizes[0] / 2) == (codec == "deflate")
    folder = str(tmp_path / "a")
    assert containers.write_alert_files(made, folder, codec, counted=made.select("diaSource.*")).first().alerts == 20
    assert sorted(map(str, containers.read_alert_files(spark, folder).collect())) == sorted(map(str, made.collect()))
    read: list[int] = []
    some = containers.read_alert_files(spark, folder, made.select("diaSourceId", "name").schema)
    assert sorted(map(tuple, some.collect())) == [(i, f"n{i}") for i in range(20)]
    body = bytes(alerts.avro_bodies(made.where("diaSourceId = 0")).first().body)
    monkeypatch.setattr(alerts.struct, "unpack_from", lambda *a: read.append(1) or (0.0,))
    assert alerts.decode_avro(made.schema, body, 0, {"name"}) == ({"name": "n0"}, len(body)) and not read


def test_components_are_solved_in_their_patch_and_across_its_edges(spark, monkeypatch):
    """Chains of sources and objects over an edge of narrow patches, against wide ones where nothing reaches the distributed search."""
    rng = random.Random(5)
    at = lambda: (10 + rng.uniform(0, 14) / 3600, rng.uniform(1000, 1014) / 3600)
    objects = spark.createDataFrame([(i, *at()) for i in range(60)], "diaObjectId bigint, ra double, dec double")
    sources = spark.createDataFrame([(i, 1 + i % 2, 3, *at()) for i in range(120)], "diaSourceId bigint, visit bigint, detector int, ra double, dec double")
    searched, search = [], assign.pair_components
    monkeypatch.setattr(assign, "pair_components", lambda pairs: searched.append(pairs.count()) or search(pairs))
    wide, narrow = ({tuple(r) for r in assign.match(sources, objects, MatchConfig(patch_radii=n)).collect()} for n in (20_000.0, 4.0))
    assert wide == narrow and len(wide) > 50 and searched[0] == 0 < searched[1]

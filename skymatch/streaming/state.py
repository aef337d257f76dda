"""Statistics of objects as the state of a stream: sources come in any order of time, late visits included, and no history is read again.

The state lies in groups of objects (a hash of the id, so a crowded field is spread). Per object and band it holds counts, weighted sums, moments and
extremes, which new rows are added to, and the times and fluxes in order, into which a late source is sorted: the slopes on both of its sides are new, and
the one that it parts is gone. A source that comes twice is counted once. The statistics are those of ``operators.stats``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Groups of objects, fixed for the life of a stream: the most tasks that its state can be spread over.
GROUPS = 1024
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATISTICS = "psfFluxMean double, psfFluxMeanErr double, psfFluxNdata long, psfFluxSigma double, psfFluxMin double, psfFluxMax double, psfFluxMaxSlope double, psfFluxErrMean double, scienceFluxMean double, scienceFluxMeanErr double"
#: A row per object and band, and one without a band for the object as a whole.
RESULT = f"diaObjectId long, band string, ra double, dec double, nDiaSources long, {STATISTICS}"

#: Parts of a group of objects that the state is read and written by, fixed for the life of a stream as well.
PAGES = 1024
#: Rows of a group that are taken in at once.
SLICE_ROWS = 200_000

_PAGE_STATE = "names string, bands binary, sources binary, places binary"
_BAND = np.dtype([("object", "<i8"), ("band", "<i4"), ("touched", "?"), ("n", "<i8"), ("mean", "<f8"), ("m2", "<f8"), ("low", "<f8"), ("high", "<f8"), ("measured", "<i8"), ("w", "<f8"), ("wf", "<f8"), ("errors", "<i8"), ("errSum", "<f8"), ("sw", "<f8"), ("swf", "<f8")])
#: Of every band (``row`` of the table above), in order of time and id.
_SOURCE = np.dtype([("row", "<i4"), ("id", "<i8"), ("time", "<f8"), ("flux", "<f8")])
_PLACE = np.dtype([("object", "<i8"), ("touched", "?"), ("x", "<f8"), ("y", "<f8"), ("z", "<f8"), ("n", "<i8")])
_NEW_BAND = (np.zeros(0, _BAND), np.zeros(0, _SOURCE))


def _weights(flux: np.ndarray, err: np.ndarray) -> np.ndarray:
    """1 / err^2 where flux and error are finite and the error positive, else 0."""
    good = np.isfinite(flux) & np.isfinite(err) & (err > 0)
    return np.where(good, 1 / np.square(np.where(good, err, 1.0)), 0.0)


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first position of every different row of keys, in order of the keys, and the number of each row's."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _take_in(state: tuple[np.ndarray, np.ndarray], objects: np.ndarray, bands: np.ndarray, rows: pd.DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The state of objects and bands with further rows of them, and which of the rows are new."""
    old, kept = state
    at = rows["diaSourceId"].to_numpy(np.int64)
    first, _ = _firsts(np.concatenate([old["object"][kept["row"]], objects]), np.concatenate([old["band"][kept["row"]], bands]), np.concatenate([kept["id"], at]))  # of equal rows the sort keeps the earlier first
    new = np.zeros(len(at), dtype=bool)
    new[first[first >= len(kept)] - len(kept)] = True
    first, number = _firsts(np.concatenate([old["object"], objects]), np.concatenate([old["band"], bands]))
    table = np.zeros(len(first), _BAND)
    table["low"], table["high"] = math.inf, -math.inf
    table["object"], table["band"] = np.concatenate([old["object"], objects])[first], np.concatenate([old["band"], bands])[first]
    table[number[: len(old)]] = old
    of = number[len(old) :]
    table["touched"][of] = True
    of = of[new]
    flux, err, science, science_err, mjd = (rows[c].to_numpy(np.float64)[new] for c in ("psfFlux", "psfFluxErr", "scienceFlux", "scienceFluxErr", "midpointMjdTai"))
    count = lambda which: np.bincount(of[which], minlength=len(table))
    total = lambda values, which=slice(None): np.bincount(of[which], values[which], len(table))
    finite = np.isfinite(flux)
    n = count(finite)
    middle = total(flux, finite) / np.maximum(n, 1)
    apart = np.bincount(of[finite], np.square(flux[finite] - middle[of[finite]]), len(table))
    both = np.maximum(table["n"] + n, 1)
    shift = np.where(n > 0, middle - table["mean"], 0.0)
    table["m2"] += apart + shift * shift * table["n"] * n / both
    table["mean"] += shift * n / both
    table["n"] += n
    seen = ~np.isnan(flux)
    np.minimum.at(table["low"], of[seen], flux[seen])
    np.maximum.at(table["high"], of[seen], flux[seen])
    weight, science_weight = _weights(flux, err), _weights(science, science_err)
    table["measured"] += count(weight > 0)
    table["w"] += total(weight)
    table["wf"] += total(weight * np.where(weight > 0, flux, 0.0))
    table["sw"] += total(science_weight)
    table["swf"] += total(science_weight * np.where(science_weight > 0, science, 0.0))
    good = np.isfinite(err)
    table["errors"] += count(good)
    table["errSum"] += total(err, good)
    sources = np.empty(len(kept) + len(of), _SOURCE)
    for name, before, more in (("row", number[: len(old)][kept["row"]], of), ("id", kept["id"], at[new]), ("time", kept["time"], mjd), ("flux", kept["flux"], flux)):
        sources[name] = np.concatenate([before, more])
    return (table, sources[np.lexsort((sources["id"], sources["time"], sources["row"]))]), new


def _results(state: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    """The columns of STATISTICS for all rows of a state; NaN says null."""
    table, sources = state
    valid = sources[np.isfinite(sources["flux"]) & ~np.isnan(sources["time"])]
    same = valid["row"][1:] == valid["row"][:-1]
    row, step, rise = valid["row"][1:][same], np.diff(valid["time"])[same], np.diff(valid["flux"])[same]
    slope = np.full(len(table), -math.inf)
    np.maximum.at(slope, row[step > 0], rise[step > 0] / step[step > 0])
    has_slope = np.bincount(row[step > 0], minlength=len(table)) > 0
    told = lambda good, values: np.where(good, values, np.nan)
    over = lambda a, b: told(b > 0, a / np.where(b > 0, b, 1))
    w, sw, n, low, high = (table[c] for c in ("w", "sw", "n", "low", "high"))
    columns = (
        over(table["wf"], w), np.sqrt(over(1.0, w)), table["measured"], told(n > 1, np.sqrt(table["m2"] / np.maximum(n - 1, 1))), told(low <= high, low), told(low <= high, high),
        told(has_slope, slope), over(table["errSum"], table["errors"]), over(table["swf"], sw), np.sqrt(over(1.0, sw)),
    )
    return pd.DataFrame(dict(zip((f.split()[0] for f in STATISTICS.split(", ")), columns, strict=True)))


def add_sources(state: tuple, rows: pd.DataFrame) -> tuple[tuple, np.ndarray]:
    """The state of an object and band with further rows of it, and which of the rows are new."""
    alike = np.zeros(len(rows), np.int64)
    return _take_in(state, alike, alike.astype(np.int32), rows)


def band_results(state: tuple) -> tuple:
    """The columns of STATISTICS from the state of an object and band."""
    return tuple(None if v != v else v for v in next(_results(state).itertuples(index=False, name=None)))


def _page(objects: np.ndarray, pages: int) -> np.ndarray:
    """The page of an object in its group, whose hash is another."""
    mixed = objects.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(pages)).astype(np.int64)


class ObjectStatistics(StatefulProcessor):
    """Adds a batch's sources to the objects of one group and gives the statistics of those that changed.

    The state is read and written a page of objects at a time, and all pages that a batch touches are worked on as columns, so a batch costs a few calls per
    page and not per object.
    """

    def __init__(self, pages: int = PAGES):
        self.pages_a_group = pages

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("pages", "page int", _PAGE_STATE)

    def _add_pages(self, wanted: np.ndarray, names: list[str], state: tuple, places: np.ndarray) -> tuple[tuple, np.ndarray]:
        """The state with that of further pages; bands take the numbers that ``names`` gives them."""
        tables, kept, where = [state[0]], [state[1]], [places]
        rows = len(state[0])
        for page in wanted.tolist():
            value = self.pages.getValue((page,)) if self.pages.containsKey((page,)) else None
            if value is None:
                continue
            own, table, sources, more = json.loads(value[0]), np.frombuffer(value[1], _BAND).copy(), np.frombuffer(value[2], _SOURCE).copy(), np.frombuffer(value[3], _PLACE).copy()
            names += [n for n in own if n not in names]
            table["band"] = np.array([names.index(n) for n in own], np.int32)[table["band"]]
            sources["row"] += rows
            rows += len(table)
            tables, kept, where = [*tables, table], [*kept, sources], [*where, more]
        return (np.concatenate(tables), np.concatenate(kept)), np.concatenate(where)

    def _keep(self, names: list[str], state: tuple, places: np.ndarray) -> None:
        """Write all pages of a state."""
        table, sources = state[0].copy(), state[1].copy()
        page = _page(table["object"], self.pages_a_group)
        order = np.argsort(page, kind="stable")
        to = np.empty(len(order), np.int32)
        to[order] = np.arange(len(order))
        table, page = table[order], page[order]
        sources["row"] = to[sources["row"]]
        sources = sources[np.argsort(sources["row"], kind="stable")]
        place_page = _page(places["object"], self.pages_a_group)
        by_page = np.argsort(place_page, kind="stable")
        places, place_page = places[by_page].copy(), place_page[by_page]
        table["touched"], places["touched"] = False, False
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(page)) + 1, [len(page)]])
        cuts = np.searchsorted(sources["row"], bounds)
        text = json.dumps(names)
        for i in range(len(bounds) - 1):
            own = sources[cuts[i] : cuts[i + 1]].copy()
            own["row"] -= bounds[i]
            number = int(page[bounds[i]])
            there = places[np.searchsorted(place_page, number) : np.searchsorted(place_page, number, "right")]
            self.pages.updateValue((number,), (text, table[bounds[i] : bounds[i + 1]].tobytes(), own.tobytes(), there.tobytes()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        names: list[str] = []
        held = np.zeros(0, np.int64)
        state, places = _NEW_BAND, np.zeros(0, _PLACE)
        for part in _slices(rows):
            objects = part["diaObjectId"].to_numpy(np.int64)
            wanted = np.setdiff1d(_page(objects, self.pages_a_group), held)
            state, places = self._add_pages(wanted, names, state, places)
            held = np.concatenate([held, wanted])
            codes, found = pd.factorize(part["band"].where(part["band"].notna(), "").astype(str))
            names += [n for n in found if n not in names]
            bands = np.array([names.index(n) for n in found], np.int32)[codes]
            state, new = _take_in(state, objects, bands, part)
            ra, dec = (np.radians(part[c].to_numpy(np.float64)) for c in ("ra", "dec"))
            first, number = _firsts(np.concatenate([places["object"], objects]))
            before, places = places, np.zeros(len(first), _PLACE)
            places["object"] = np.concatenate([before["object"], objects])[first]
            places[number[: len(before)]] = before
            of = number[len(before) :]
            places["touched"][of] = True
            good = new & ~np.isnan(ra) & ~np.isnan(dec)
            of, ra, dec = of[good], ra[good], dec[good]
            for c, values in (("x", np.cos(dec) * np.cos(ra)), ("y", np.cos(dec) * np.sin(ra)), ("z", np.sin(dec))):
                places[c] += np.bincount(of, values, len(places))
            places["n"] += np.bincount(of, minlength=len(places))
        if not len(held):
            return
        table = state[0]
        named = np.array([n != "" for n in names])[table["band"]] & table["touched"]
        of_bands = pd.concat([pd.DataFrame({"diaObjectId": table["object"], "band": np.array(names, dtype=object)[table["band"]]}), _results(state)], axis=1)[named]
        seen = places[places["touched"] & (places["n"] > 0)]
        of_objects = pd.DataFrame({"diaObjectId": seen["object"], "ra": np.degrees(np.arctan2(seen["y"], seen["x"])) % 360, "dec": np.degrees(np.arctan2(seen["z"], np.hypot(seen["x"], seen["y"]))), "nDiaSources": seen["n"]})
        self._keep(names, state, places)
        columns = [f.split()[0] for f in RESULT.split(", ")]
        for out in (of_bands, of_objects):
            if len(out):
                whole = ("nDiaSources", "psfFluxNdata")
                kinds = {c: "Int64" if c in whole else "float64" for c in columns if c not in ("diaObjectId", "band")}
                yield out.reindex(columns=columns).astype(kinds | {"band": object}).reset_index(drop=True)

    def close(self) -> None:
        pass


def _slices(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in parts of about SLICE_ROWS."""
    held: list[pd.DataFrame] = []
    for chunk in chunks:
        held.append(chunk)
        if sum(map(len, held)) >= SLICE_ROWS:
            yield pd.concat(held, ignore_index=True)
            held = []
    if sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def statistics_stream(spark: SparkSession, source_path: str, schema, out: str, checkpoint: str, files_a_batch: int = 1, groups: int = GROUPS) -> DataFrame:
    """Take in all files of sources (with their diaObjectId) that have arrived, and return the newest statistics: a row per object and band, and one with
    a null band per object for its position and number of sources.

    Sources without an object are left out. A batch that is run again replaces what it wrote; the state is as exact as the stream's checkpoint.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["diaObjectId", "diaSourceId", "band", "ra", "dec", "midpointMjdTai", "psfFlux", "psfFluxErr", "scienceFlux", "scienceFluxErr"]
    rows = own.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source_path).where("diaObjectId <> 0").select(columns)
    keyed = rows.withColumn("cluster", F.pmod(F.xxhash64("diaObjectId"), F.lit(groups)).cast("int"))
    found = keyed.groupBy("cluster").transformWithStateInPandas(ObjectStatistics(), RESULT, "Update", "none")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    found.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    written = spark.read.schema(f"{RESULT}, batch int").option("basePath", out).parquet(f"{out}/batch=*")
    return written.groupBy("diaObjectId", "band").agg(F.max_by(F.struct(*[c for c in written.columns if c not in ("diaObjectId", "band", "batch")]), "batch").alias("r")).select("diaObjectId", "band", "r.*")

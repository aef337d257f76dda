"""Measurements in physical units: a registry of functions from column names to a column, and the projection that uses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import pixel_scale, position_angle

CALIB, CALIB_ERR = "base_LocalPhotoCalib", "base_LocalPhotoCalibErr"
CD = ("base_LocalWcs_CDMatrix_1_1", "base_LocalWcs_CDMatrix_1_2", "base_LocalWcs_CDMatrix_2_1", "base_LocalWcs_CDMatrix_2_2")


def _cd() -> tuple[Column, Column, Column, Column]:
    return tuple(map(F.col, CD))


def _scale() -> Column:
    return pixel_scale(_cd())


def flux(name: str) -> Column:
    """Instrumental flux to nanojansky."""
    return F.col(name) * F.col(CALIB)


def flux_error(err: str, name: str) -> Column:
    return F.sqrt(F.pow(F.col(err) * F.col(CALIB), 2) + F.pow(F.col(name) * F.col(CALIB_ERR), 2))


def _lobes(prefix: str) -> tuple[Column, Column]:
    return F.abs(F.col(f"{prefix}_pos_instFlux")) * F.col(CALIB), F.abs(F.col(f"{prefix}_neg_instFlux")) * F.col(CALIB)


def _lobe_errors(prefix: str) -> Column:
    return F.sqrt(F.pow(F.col(f"{prefix}_pos_instFluxErr"), 2) + F.pow(F.col(f"{prefix}_neg_instFluxErr"), 2)) * F.col(CALIB)


FUNCTORS: dict[str, Callable[..., Column]] = {
    "Column": F.col,
    "RAColumn": lambda: F.degrees("coord_ra"),
    "DecColumn": lambda: F.degrees("coord_dec"),
    "RAErrColumn": lambda: F.degrees("coord_raErr"),
    "DecErrColumn": lambda: F.degrees("coord_decErr"),
    "RADecCovColumn": lambda: F.col("coord_ra_dec_Cov") * F.pow(F.degrees(F.lit(1.0)), 2),
    "LocalNanojansky": flux,
    "LocalNanojanskyErr": flux_error,
    "ConvertPixelToArcseconds": lambda c: F.col(c) * _scale(),
    "ConvertPixelSqToArcsecondsSq": lambda c: F.col(c) * F.pow(_scale(), 2),
    "ConvertDetectorAngleToPositionAngle": lambda c: position_angle(F.col(c), _cd()),
    "ConvertDetectorAngleErrToPositionAngleErr": lambda c: F.degrees(c),
    "LocalDipoleMeanFlux": lambda p: (_lobes(p)[0] + _lobes(p)[1]) / 2,
    "LocalDipoleMeanFluxErr": lambda p: _lobe_errors(p) / 2,
    "LocalDipoleDiffFlux": lambda p: _lobes(p)[0] - _lobes(p)[1],
    "LocalDipoleDiffFluxErr": _lobe_errors,
}

_TRAIL, _DIPOLE, _FORCED, _TEMPLATE = "ext_trailedSources_Naive", "ip_diffim_DipoleFit", "ip_diffim_forced_PsfFlux", "ip_diffim_forced_template_PsfFlux"
_SAME = (
    "visit detector band diaObjectId ssObjectId bboxSize midpointMjdTai timeProcessedMjdTai flags snr reliability reliabilityVersion glint_trail"
).split()
#: Output column, functor, arguments.
PROJECTION: list[tuple[str, str, tuple[str, ...]]] = (
    [(c, "Column", (c,)) for c in _SAME]
    + [
        (out, "Column", (raw,))
        for out, raw in {
            "diaSourceId": "id", "parentDiaSourceId": "parent", "x": "slot_Centroid_x", "y": "slot_Centroid_y", "xErr": "slot_Centroid_xErr", "yErr": "slot_Centroid_yErr",
            "psfChi2": "slot_PsfFlux_chi2", "psfNdata": "slot_PsfFlux_npixels", "trailRa": f"{_TRAIL}_ra", "trailDec": f"{_TRAIL}_dec", "trailAlgorithm": f"{_TRAIL}_algorithmKey",
            "dipoleChi2": f"{_DIPOLE}_chi2dof", "isDipole": f"{_DIPOLE}_classification", "isNegative": "is_negative", "dipoleFitAttempted": f"{_DIPOLE}_classificationAttempted",
            "dipoleNdata": f"{_DIPOLE}_nData", "extendedness": "base_ClassificationSizeExtendedness_value",
        }.items()
    ]
    + [("ra", "RAColumn", ()), ("dec", "DecColumn", ()), ("raErr", "RAErrColumn", ()), ("decErr", "DecErrColumn", ()), ("ra_dec_Cov", "RADecCovColumn", ())]
    + [
        row
        for out, raw in {"apFlux": "slot_ApFlux_instFlux", "psfFlux": "slot_PsfFlux_instFlux", "trailFlux": f"{_TRAIL}_flux", "scienceFlux": f"{_FORCED}_instFlux", "templateFlux": f"{_TEMPLATE}_instFlux"}.items()
        for row in ((out, "LocalNanojansky", (raw,)), (f"{out}Err", "LocalNanojanskyErr", (f"{raw}Err", raw)))
    ]
    + [(out, "ConvertPixelToArcseconds", (raw,)) for out, raw in {"trailLength": f"{_TRAIL}_length", "trailLengthErr": f"{_TRAIL}_lengthErr", "dipoleLength": f"{_DIPOLE}_separation"}.items()]
    + [("trailAngle", "ConvertDetectorAngleToPositionAngle", (f"{_TRAIL}_angle",)), ("dipoleAngle", "ConvertDetectorAngleToPositionAngle", (f"{_DIPOLE}_orientation",)), ("trailAngleErr", "ConvertDetectorAngleErrToPositionAngleErr", (f"{_TRAIL}_angleErr",))]
    + [("dipoleMeanFlux", "LocalDipoleMeanFlux", (_DIPOLE,)), ("dipoleMeanFluxErr", "LocalDipoleMeanFluxErr", (_DIPOLE,)), ("dipoleFluxDiff", "LocalDipoleDiffFlux", (_DIPOLE,)), ("dipoleFluxDiffErr", "LocalDipoleDiffFluxErr", (_DIPOLE,))]
    + [(f"i{m}{suffix}", "ConvertPixelSqToArcsecondsSq", (f"slot_{shape}_{m}",)) for shape, suffix in (("Shape", ""), ("PsfShape", "PSF")) for m in ("xx", "yy", "xy")]
)


def projection(available: list[str], wanted: list[tuple[str, str, tuple[str, ...]]] | None = None) -> list[Column]:
    """Columns of the projection; an output whose raw columns are not there is left out, for the schema to fill with nulls."""
    out = []
    have = set(available)
    for name, functor, args in wanted or PROJECTION:
        column = FUNCTORS[functor](*args)
        if _needs(functor, args) <= have:
            out.append(column.alias(name))
    return out


def _needs(functor: str, args: tuple[str, ...]) -> set[str]:
    if functor in ("RAColumn", "DecColumn", "RAErrColumn", "DecErrColumn", "RADecCovColumn"):
        return {{"RAColumn": "coord_ra", "DecColumn": "coord_dec", "RAErrColumn": "coord_raErr", "DecErrColumn": "coord_decErr", "RADecCovColumn": "coord_ra_dec_Cov"}[functor]}
    if functor.startswith("LocalDipole"):
        suffix = "instFluxErr" if functor.endswith("Err") else "instFlux"
        return {f"{args[0]}_pos_{suffix}", f"{args[0]}_neg_{suffix}", CALIB}
    if functor.startswith("LocalNanojansky"):
        return {*args, CALIB} | ({CALIB_ERR} if functor.endswith("Err") else set())
    if functor.startswith("Convert") and not functor.startswith("ConvertDetectorAngleErr"):
        return {*args, *CD}
    return set(args)

"""Standard schemas, and the projection that brings a table to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BANDS = ("u", "g", "r", "i", "z", "y")
_L, _D, _F, _S, _B, _I, _H = T.LongType(), T.DoubleType(), T.FloatType(), T.StringType(), T.BooleanType(), T.IntegerType(), T.ShortType()


def _fields(**kinds: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, k) for n, k in kinds.items()]


DIA_SOURCE = T.StructType(
    _fields(diaSourceId=_L, visit=_L, detector=_H, band=_S, diaObjectId=_L, ssObjectId=_L, parentDiaSourceId=_L, midpointMjdTai=_D, timeProcessedMjdTai=_D, ra=_D, dec=_D, raErr=_F, decErr=_F, ra_dec_Cov=_F, x=_F, y=_F, xErr=_F, yErr=_F)
    + [T.StructField(f"{n}{e}", _F) for n in ("apFlux", "psfFlux", "trailFlux", "scienceFlux", "templateFlux", "dipoleMeanFlux") for e in ("", "Err")]
    + _fields(dipoleFluxDiff=_F, dipoleFluxDiffErr=_F, snr=_F, psfChi2=_F, psfNdata=_I, trailRa=_D, trailDec=_D, trailLength=_F, trailLengthErr=_F, trailAngle=_F, trailAngleErr=_F, trailAlgorithm=_I, dipoleLength=_F, dipoleAngle=_F, dipoleChi2=_F, dipoleNdata=_I)
    + _fields(isDipole=_B, isNegative=_B, dipoleFitAttempted=_B, ixx=_F, iyy=_F, ixy=_F, ixxPSF=_F, iyyPSF=_F, ixyPSF=_F, extendedness=_F, reliability=_F, reliabilityVersion=_S, glint_trail=_B, bboxSize=_L, flags=_L)
)
DIA_OBJECT = T.StructType(
    _fields(diaObjectId=_L, validityStartMjdTai=_D, ra=_D, dec=_D, raErr=_F, decErr=_F, nDiaSources=_L)
    + [T.StructField(f"{b}_{n}", _L if n.endswith("Ndata") else _F) for b in BANDS for n in ("psfFluxMean", "psfFluxMeanErr", "psfFluxNdata", "psfFluxSigma", "psfFluxMin", "psfFluxMax", "psfFluxMaxSlope", "psfFluxErrMean", "scienceFluxMean", "scienceFluxMeanErr")]
)
DIA_FORCED_SOURCE = T.StructType(_fields(diaForcedSourceId=_L, diaObjectId=_L, visit=_L, detector=_H, ra=_D, dec=_D, psfFlux=_F, psfFluxErr=_F, scienceFlux=_F, scienceFluxErr=_F, midpointMjdTai=_D, timeProcessedMjdTai=_D, band=_S))
SCHEMAS = {"diaSource": DIA_SOURCE, "diaObject": DIA_OBJECT, "diaForcedSource": DIA_FORCED_SOURCE}
KEYS = {"diaSource": ["diaObjectId", "band", "diaSourceId"], "diaObject": ["diaObjectId"], "diaForcedSource": ["diaObjectId", "diaForcedSourceId"]}


def schema(table: str) -> T.StructType:
    if table not in SCHEMAS:
        raise KeyError(f"no standard table {table}")
    return SCHEMAS[table]


def conform(df: DataFrame, table: str | T.StructType) -> DataFrame:
    """The columns of the standard schema in its order and types: missing ones null, others dropped."""
    fields = schema(table) if isinstance(table, str) else table
    have = set(df.columns)
    # As text, which is parsed at once; columns built one by one cost a wide table many calls each.
    return df.selectExpr(*[f"cast({quoted(f.name) if f.name in have else 'null'} as {f.dataType.simpleString()}) as {quoted(f.name)}" for f in fields])


def quoted(name: str) -> str:
    """A column's name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def empty_forced(spark: SparkSession) -> DataFrame:
    """The two-column table that stands for no forced sources."""
    return spark.createDataFrame([], "diaObjectId long, diaForcedSourceId long")


def require(df: DataFrame, columns: list[str], what: str, error: type[Exception] = RuntimeError) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise error(f"{what} lacks {missing}")


def require_integer(df: DataFrame, column: str) -> None:
    """Ids must be whole numbers; floats lose them."""
    if not isinstance(df.schema[column].dataType, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        raise ValueError(f"{column} is {df.schema[column].dataType.simpleString()}, not an integer")

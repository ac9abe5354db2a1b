"""Explicit schemas. The measures the two products publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

METEOROLOGY = (
    "T2M", "T2MDEW", "T2MWET", "T2M_MAX", "T2M_MIN", "T2M_RANGE", "TS",
    "RH2M", "QV2M", "PRECTOTCORR",
    "WS2M", "WS10M", "WS50M", "WD2M", "WD10M", "WD50M",
    "PS", "GWETROOT", "GWETTOP", "EVPTRNS",
)
RADIATION = (
    "ALLSKY_KT", "ALLSKY_SFC_LW_DWN", "ALLSKY_SFC_LW_UP", "ALLSKY_SFC_PAR_TOT",
    "ALLSKY_SFC_SW_DIFF", "ALLSKY_SFC_SW_DNI", "ALLSKY_SFC_SW_DWN", "ALLSKY_SFC_SW_UP",
    "ALLSKY_SFC_UV_INDEX", "ALLSKY_SFC_UVA", "ALLSKY_SFC_UVB", "ALLSKY_SRF_ALB",
    "AOD_55", "AOD_55_ADJ", "CLOUD_AMT", "CLOUD_AMT_DAY", "CLOUD_AMT_NIGHT",
    "CLOUD_OD", "CLRSKY_DAYS", "CLRSKY_KT", "CLRSKY_SFC_LW_DWN", "CLRSKY_SFC_LW_UP",
    "CLRSKY_SFC_PAR_TOT", "CLRSKY_SFC_SW_DIFF", "CLRSKY_SFC_SW_DWN", "CLRSKY_SFC_SW_UP",
    "CLRSKY_SRF_ALB", "MIDDAY_INSOL", "TOA_SW_DNI", "TOA_SW_DWN",
)


def daily_schema(params: Sequence[str]) -> T.StructType:
    """``time DATE, lat DOUBLE, lon DOUBLE`` and one DOUBLE per measure."""
    fields = [T.StructField("time", T.DateType()), T.StructField("lat", T.DoubleType()),
              T.StructField("lon", T.DoubleType())]
    return T.StructType(fields + [T.StructField(p, T.DoubleType()) for p in params])


def component_schema(size: int) -> T.StructType:
    names = ["lat", "lon", *[f"PC{i + 1}" for i in range(size)]]
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


ASSIGNMENTS = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("cluster", T.IntegerType()),
    ]
)

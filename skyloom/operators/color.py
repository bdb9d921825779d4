"""Catalogue magnitudes in an image's instrument system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.response import eval_response


def instrument_mag(stars: DataFrame, model: dict[str, float], mag: str = "cat_mag") -> DataFrame:
    """Adds instrument_mag: the catalogue magnitude less what the model adds to magnitude 0 of that star's colours."""
    rows = eval_response(stars.withColumn("_zero", F.lit(0.0)), model, mag="_zero", out="_m")
    return rows.withColumn("instrument_mag", F.col(mag) - F.col("_m")).drop("_zero", "_m")


def differential_correction(df: DataFrame, model: dict[str, float], neutral: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0), color_correction: bool = True) -> DataFrame:
    """Adds correction: the model at the row's colours less the model at neutral colours, the zeropoint left out;
    0 with ``color_correction=False``."""
    if not color_correction:
        return df.withColumn("correction", F.lit(0.0))
    base = df.withColumn("_zero", F.lit(0.0))
    own = eval_response(base, model, mag="_zero", out="_own", skip=("Z",))
    names = [f"color{i}" for i in range(1, 5)]
    plain = own.withColumnsRenamed({c: f"_{c}" for c in names if c in df.columns}).withColumns({c: F.lit(v) for c, v in zip(names, neutral)})
    both = eval_response(plain, model, mag="_zero", out="_plain", skip=("Z",)).drop(*names)
    back = both.withColumnsRenamed({f"_{c}": c for c in names if c in df.columns})
    return back.withColumn("correction", F.col("_own") - F.col("_plain")).drop("_zero", "_own", "_plain")

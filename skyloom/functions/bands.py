"""Magnitude transformations and magnitude errors, as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def polynomial(x: Column, *coefficients: float) -> Column:
    """c1*x + c2*x^2 + ... by Horner's rule."""
    return reduce(lambda acc, c: (acc + c) * x, reversed(coefficients), F.lit(0.0))


#: Coefficients of the colour transformations.
SLOAN = {"b": (1.490989, 0.125787, -0.022359), "b0": 0.186304, "v": (0.510236,), "v0": -0.0337082, "r": (-0.197420, -0.083113), "r0": -0.179943, "i": (-0.897087,), "iz": (-0.575316,), "i0": -0.423971}
GAIA = {
    "b": ((), (0.666169, 0.145798, 0.517584), 0.0085),
    "v": ((0.368628, 0.139117), (-0.103787, 0.194751, 0.156161), 0.0052),
    "r": ((-0.036933, -0.083075, 0.022532), (-0.353593, -0.482768, 0.728803), 0.0167),
    "i": ((-0.395266, 0.183776, -0.020945), (0.253449, -0.113991), -0.0660),
}
#: Fixed value: J from AB to Vega.
J_VEGA = -0.894


def sloan_to_johnson(df: DataFrame) -> DataFrame:
    """Adds johnson_b, johnson_v, johnson_r, johnson_i from sloan_g, sloan_r, sloan_i, sloan_z."""
    r, gr, ri, iz = F.col("sloan_r"), F.col("sloan_g") - F.col("sloan_r"), F.col("sloan_r") - F.col("sloan_i"), F.col("sloan_i") - F.col("sloan_z")
    return df.withColumns(
        {
            "johnson_b": r + polynomial(gr, *SLOAN["b"]) + SLOAN["b0"],
            "johnson_v": r + polynomial(gr, *SLOAN["v"]) + SLOAN["v0"],
            "johnson_r": r + polynomial(ri, *SLOAN["r"]) + SLOAN["r0"],
            "johnson_i": r + polynomial(ri, *SLOAN["i"]) + polynomial(iz, *SLOAN["iz"]) + SLOAN["i0"],
        }
    )


def gaia_to_johnson(df: DataFrame) -> DataFrame:
    """Adds johnson_b, johnson_v, johnson_r, johnson_i from g, bp, rp."""
    bpg, grp = F.col("bp") - F.col("g"), F.col("g") - F.col("rp")
    base = {"b": F.col("bp"), "v": F.col("g"), "r": F.col("g"), "i": F.col("rp")}
    return df.withColumns({f"johnson_{k}": base[k] + polynomial(bpg, *c) + polynomial(grp, *d) + zero for k, (c, d, zero) in GAIA.items()})


def atlas_co(df: DataFrame) -> DataFrame:
    """Adds the synthetic bands cyan and orange."""
    gr, ri = F.col("sloan_g") - F.col("sloan_r"), F.col("sloan_r") - F.col("sloan_i")
    return df.withColumns({"cyan": F.col("sloan_g") - polynomial(gr, 0.467, 0.048), "orange": F.col("sloan_r") - polynomial(ri, 0.443, 0.090)})


def j_vega(df: DataFrame) -> DataFrame:
    """Adds j_vega from j (AB)."""
    return df.withColumn("j_vega", F.col("j") + J_VEGA)


def schema_colors(df: DataFrame, schema: list[str]) -> DataFrame:
    """Adds color1..color4, differences of neighbouring bands; a shorter schema wraps around."""
    n = len(schema)
    return df.withColumns({f"color{i + 1}": F.col(schema[i % n]) - F.col(schema[(i + 1) % n]) for i in range(4)})


def mag_err_from_snr(snr: Column) -> Column:
    """Magnitude error from flux over its error; null where that is zero or null."""
    return F.try_divide(F.lit(2.5), snr * F.log(F.lit(10.0)))


def parallax_err(parallax: Column, over_error: Column) -> Column:
    """Parallax over (parallax over error), 0 where that is not finite; null parallax counts 0, null ratio 1."""
    value = F.try_divide(F.coalesce(parallax, F.lit(0.0)), F.coalesce(over_error, F.lit(1.0)))
    return F.coalesce(F.when(F.isnan(value) | (F.abs(value) == float("inf")), 0.0).otherwise(value), F.lit(0.0))


def fill_mag_err(df: DataFrame, bands: dict[str, str | None]) -> DataFrame:
    """Default errors 0.1 (brighter than 19) or 0.2 for each ``{magnitude column: error column}`` whose error
    column is None (then ``<band>_err`` is added) or has no value but 0 and null in the whole table."""
    present = {m: e for m, e in bands.items() if e}
    used = df.agg(*[F.max(F.abs(F.coalesce(F.col(e), F.lit(0.0)))).alias(m) for m, e in present.items()]).first() if present else {}
    fill = {}
    for magnitude, error in bands.items():
        if error is None or not used[magnitude]:
            fill[error or f"{magnitude}_err"] = F.when(F.col(magnitude) < 19, 0.1).otherwise(F.lit(0.2))
    return df.withColumns(fill)


def zero_nulls(df: DataFrame, columns: tuple[str, ...] = ("pmra", "pmdec", "parallax")) -> DataFrame:
    """Null and NaN become 0; missing columns are added."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in columns})


def sum_mag(magnitude: Column) -> Column:
    """Magnitude of the summed light, an aggregate."""
    return -2.5 * F.log10(F.sum(F.pow(F.lit(10.0), -0.4 * magnitude)))

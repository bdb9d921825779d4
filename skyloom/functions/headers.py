"""Image metadata: names, times, defaults, coordinates as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Other spellings of filter names.
FILTER_NAMES = {
    "OIII": "oiii",
    "Halpha": "halpha",
    "u": "Sloan_u",
    "g": "Sloan_g",
    "r": "Sloan_r",
    "i": "Sloan_i",
    "z": "Sloan_z",
    "UKIRT Z": "UKIRT_z",
    "SDSS g'": "Sloan_g",
    "SDSS r'": "Sloan_r",
    "SDSS i'": "Sloan_i",
    "UNK": "N",
    "C": "N",
    "clear": "N",
    "Clear": "N",
}
#: The site that stands for a missing one (latitude, longitude, altitude in m).
DEFAULT_SITE = {"latitude": 49.9090806, "longitud": 14.7819092, "altitude": 530.0}
#: JD of the unix epoch and of MJD 0.
JD_UNIX, JD_MJD = 2440587.5, 2400000.5


def normalize_filter(name: Column) -> Column:
    """The standard name of a filter; null is ``N``."""
    names = F.create_map(*[F.lit(x) for pair in FILTER_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, name), name, F.lit("N"))


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def reconcile_time(images: DataFrame) -> DataFrame:
    """Sets ctime (unix seconds), jd and mjd_obs from the first that is present of ctime + usec, date_obs,
    mjd_obs or mjd, jd or jd_start; adds time_conflicts, the pairs of sources that differ by more than a millisecond
    (``ux/do`` and so on), comma-separated. Missing columns count as null."""
    ux = _column(images, "ctime", "double") + F.coalesce(_column(images, "usec", "double"), F.lit(0.0)) / 1e6
    do = F.unix_micros(F.try_to_timestamp(_column(images, "date_obs", "string"))) / 1e6
    mjd = (F.coalesce(_column(images, "mjd_obs", "double"), _column(images, "mjd", "double")) - 40587.0) * 86400
    jd = (F.coalesce(_column(images, "jd", "double"), _column(images, "jd_start", "double")) - JD_UNIX) * 86400
    sources = [("ux", ux), ("do", do), ("mjd", mjd), ("jd", jd)]
    conflicts = [F.when(F.abs(a - b) > 0.001, F.lit(f"{m}/{n}")) for i, (m, a) in enumerate(sources) for n, b in sources[i + 1 :]]
    out = images.withColumns({"_t": F.coalesce(ux, do, mjd, jd), "time_conflicts": F.concat_ws(",", *conflicts)})
    return out.withColumns({"ctime": F.col("_t"), "jd": JD_UNIX + F.col("_t") / 86400, "mjd_obs": JD_UNIX + F.col("_t") / 86400 - JD_MJD}).drop("_t")


def image_defaults(images: DataFrame) -> DataFrame:
    """Site (latitude before tel_lat before the default), chip_id (ccd_ser, else ccd_type, else unknown; an absent
    ccd_ser is unknown), obsid ``n.dd`` of obsid_n and scriprep, exptime (exposure before exptime, 0), airmass 1,
    target objra and objdec of orira and oridec or -100, ctrx and ctry half the axes."""
    c = lambda name, kind="double": _column(images, name, kind)
    serial, kind = c("ccd_ser", "string"), F.nullif(c("ccd_type", "string"), F.lit(""))
    return images.withColumns(
        {
            "latitude": F.coalesce(c("latitude"), c("tel_lat"), F.lit(DEFAULT_SITE["latitude"])),
            "longitud": F.coalesce(c("longitud"), c("tel_long"), F.lit(DEFAULT_SITE["longitud"])),
            "altitude": F.coalesce(c("altitude"), c("tel_alt"), F.lit(DEFAULT_SITE["altitude"])),
            "chip_id": F.when(serial == "", F.coalesce(kind, F.lit("unknown"))).otherwise(F.coalesce(serial, F.lit("unknown"))),
            "obsid": F.format_string("%d.%02d", F.coalesce(c("obsid_n", "int"), F.lit(0)), F.coalesce(c("scriprep", "int"), F.lit(0))),
            "exptime": F.coalesce(c("exposure"), c("exptime"), F.lit(0.0)),
            "airmass": F.coalesce(c("airmass"), F.lit(1.0)),
            "objra": F.coalesce(c("orira"), F.lit(-100.0)),
            "objdec": F.coalesce(c("oridec"), F.lit(-100.0)),
            "ctrx": F.coalesce(c("ctrx"), c("imgaxis1") / 2),
            "ctry": F.coalesce(c("ctry"), c("imgaxis2") / 2),
        }
    )


def estimate_maglimit(field: Column, n: Column, latitude: Column) -> Column:
    """Magnitude to which a field (degrees on a side) holds about ``n`` stars, of three density classes by
    galactic latitude."""
    b = F.abs(latitude)
    c = F.when(b < 20, 3.5).when(b < 40, 3.8).otherwise(4.0)
    return (F.log10(n / (field * field)) + c) / 0.6


def powerlaw_mag(t: Column, t0: float, mag0: float, rate: float) -> Column:
    """Magnitude at JD ``t`` of a source of ``mag0`` one day after ``t0``; null at and before t0."""
    return F.when(t > t0, F.lit(mag0) + rate * 2.5 * F.log10(t - t0))


def soften_errors(df: DataFrame) -> DataFrame:
    """magerr_auto with 0.0005 added in quadrature, dy (fit error, 0.02 in quadrature), image_dxy (of the
    variances, 0.005 in quadrature) and image_var (their sum)."""
    square = lambda c: F.col(c) * F.col(c)
    return df.withColumns(
        {
            "magerr_auto": F.sqrt(square("magerr_auto") + 0.0005**2),
            "dy": F.sqrt(square("magerr_auto") + 0.0004),
            "image_dxy": F.sqrt(square("errx2_image") + square("erry2_image") + 2.5e-5),
            "image_var": F.col("errx2_image") + F.col("erry2_image"),
        }
    )


def parse_coord(text: Column, is_ra: bool = False) -> Column:
    """Degrees of a decimal or sexagesimal string (separators ``: ; h m d s`` or blanks, one to three parts; the
    sign is that of a leading ``-``, also of ``-0``). An RA of at most 24 written with ``:`` is in hours. Null where a
    part is no number."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), "[hmdsHMDS:;]", " "), "\\s+", " "))
    parts = F.split(clean, " ")
    number = [F.try_element_at(parts, F.lit(i)).try_cast("double") for i in (1, 2, 3)]
    n = F.size(parts)
    size = F.abs(number[0]) + F.when(n > 1, number[1]).otherwise(F.lit(0.0)) / 60 + F.when(n > 2, number[2]).otherwise(F.lit(0.0)) / 3600
    value = F.when(clean.startswith("-"), -size).otherwise(size)
    if is_ra:
        value = F.when(text.contains(":") & (value <= 24), value * 15).otherwise(value)
    return value


def format_coord(value: Column, is_ra: bool = False, ndec: int = 3) -> Column:
    """Sexagesimal text: hours of an RA, signed degrees of a declination, truncated to minutes, ``ndec`` decimals."""
    x = F.abs(value) / (15.0 if is_ra else 1.0)
    whole = F.floor(x)
    minutes = F.floor((x - whole) * 60)
    seconds = ((x - whole) * 60 - minutes) * 60
    text = F.format_string(f"%02d:%02d:%0{4 + ndec}.{ndec}f", whole, minutes, seconds)
    return text if is_ra else F.concat(F.when(value < 0, "-").otherwise("+"), text)

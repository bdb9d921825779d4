"""Positions on the sky and in the pixel plane, as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a year for proper motion, epoch 2015.5, light travel days per AU.
YEAR = 365.2425
EPOCH = 2457204.5
LIGHT_DAYS_PER_AU = 499.004783836 / 86400


def clamp(x: Column) -> Column:
    """To [-1, 1], for acos and asin."""
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(-1.0))


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Angular distance in degrees (haversine)."""
    a = F.pow(F.sin(F.radians(dec2 - dec1) / 2), 2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(clamp(a))))


def epoch_jd(epoch: float | Column) -> float | Column:
    """A year such as 2015.5 as JD; a JD as it is."""
    if isinstance(epoch, Column):
        return F.when(epoch < 3000, (epoch - 2000.0) * YEAR + 2451544.5).otherwise(epoch)
    return (epoch - 2000.0) * YEAR + 2451544.5 if epoch < 3000 else epoch


def apply_pm(df: DataFrame, jd: str = "jd", epoch: float = EPOCH, divide_cosdec: bool = False, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Positions moved by pmra, pmdec (degrees a year) from the epoch to ``jd``. The motion in RA is added as it
    is; ``divide_cosdec`` divides it by cos dec for catalogues whose motion includes that factor."""
    years = (F.col(jd) - epoch_jd(epoch)) / YEAR
    motion = F.coalesce("pmra", F.lit(0.0)) * years
    if divide_cosdec:
        motion = motion / F.cos(F.radians(F.col(dec)))
    return df.withColumns({ra: F.col(ra) + motion, dec: F.col(dec) + F.coalesce("pmdec", F.lit(0.0)) * years})


def earth(jd: Column) -> dict[str, Column]:
    """Earth's position (x, y, z in AU, equatorial) by a short solar series, good to about 1e-4 AU."""
    n = jd - 2451545.0
    g, q = F.radians(357.529 + 0.98560028 * n), F.radians(280.459 + 0.98564736 * n)
    lon = q + F.radians(1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    r = 1.00014 - 0.01671 * F.cos(g) - 0.00014 * F.cos(2 * g)
    tilt = F.radians(23.439 - 0.00000036 * n)
    return {"earth_x": -r * F.cos(lon), "earth_y": -r * F.sin(lon) * F.cos(tilt), "earth_z": -r * F.sin(lon) * F.sin(tilt)}


def with_earth(images: DataFrame, ephemeris: DataFrame | None = None) -> DataFrame:
    """Images with earth_x, earth_y, earth_z, of the caller's ``ephemeris(jd, earth_x, earth_y, earth_z)`` if given."""
    return images.join(ephemeris, "jd", "left") if ephemeris is not None else images.withColumns(earth(F.col("jd")))


def apply_parallax(df: DataFrame, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Parallactic displacement (parallax in mas; earth_x.. as columns); no displacement where it is not positive."""
    a, d = F.radians(F.col(ra)), F.radians(F.col(dec))
    x, y, z = F.col("earth_x"), F.col("earth_y"), F.col("earth_z")
    p = F.when(F.col("parallax") > 0, F.col("parallax") / 1000).otherwise(F.lit(0.0))
    d_ra = p * (y * F.cos(a) - x * F.sin(a)) / F.cos(d)
    d_dec = p * (z * F.cos(d) - x * F.cos(a) * F.sin(d) - y * F.sin(a) * F.sin(d))
    return df.withColumns({ra: F.col(ra) + d_ra / 3600, dec: F.col(dec) + d_dec / 3600})


def airmass(zenith: Column) -> Column:
    """Rozenberg's airmass of a zenith angle in radians."""
    c = F.cos(zenith)
    return 1.0 / (c + 0.025 * F.exp(-11.0 * c))


def altitude(ra: Column, dec: Column, latitude: Column, longitude: Column, jd: Column) -> Column:
    """Altitude in radians from mean sidereal time; longitude east."""
    sidereal = 280.46061837 + 360.98564736629 * (jd - 2451545.0) + longitude
    hour = F.radians(sidereal - ra)
    lat, d = F.radians(latitude), F.radians(dec)
    return F.asin(clamp(F.sin(lat) * F.sin(d) + F.cos(lat) * F.cos(d) * F.cos(hour)))


def star_airmass(df: DataFrame, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Adds airmass_abs and adif (less the image's airmass). An airmass below 0, above 10 or NaN becomes 1; without
    site or time airmass_abs is 1 and adif 0."""
    value = airmass(math.pi / 2 - altitude(F.col(ra), F.col(dec), F.col("latitude"), F.col("longitud"), F.col("jd")))
    known = F.col("latitude").isNotNull() & F.col("longitud").isNotNull() & F.col("jd").isNotNull()
    valid = F.when(F.isnan(value) | (value < 0) | (value > 10), 1.0).otherwise(value)
    out = df.withColumn("airmass_abs", F.when(known, valid).otherwise(F.lit(1.0)))
    return out.withColumn("adif", F.when(known, F.col("airmass_abs") - F.coalesce("airmass", F.lit(1.0))).otherwise(F.lit(0.0)))


#: Projections of ``world2pix`` and of ``pix2world``.
PROJECTIONS = ("TAN", "ZEA", "ARC", "ZPN", "AZP", "SZP")


def _opt(df: DataFrame, name: str, default: float = 0.0) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)


def native(ra: Column, dec: Column, crval1: Column, crval2: Column) -> tuple[Column, Column, Column]:
    """(cos u, sin u cos b, sin u sin b): u is the distance from the reference point, b the angle about it."""
    a, d, d0 = F.radians(ra - crval1), F.radians(dec), F.radians(crval2)
    return F.sin(d) * F.sin(d0) + F.cos(d) * F.cos(d0) * F.cos(a), -F.cos(d) * F.sin(a), F.sin(d) * F.cos(d0) - F.cos(d) * F.sin(d0) * F.cos(a)


def plane(df: DataFrame, proj: str, ra: Column, dec: Column) -> tuple[Column, Column]:
    """Intermediate coordinates in degrees before the CD matrix."""
    cosu, su_cosb, su_sinb = native(ra, dec, F.col("crval1"), F.col("crval2"))
    if proj == "TAN":  # without angles, so that expressions stay small
        up = F.when(cosu > 0, cosu)
        return F.degrees(-su_cosb / up), F.degrees(su_sinb / up)
    sinu = F.sqrt(su_cosb * su_cosb + su_sinb * su_sinb)
    u = F.atan2(sinu, cosu)
    cosb, sinb = (F.when(sinu > 0, x / F.when(sinu > 0, sinu)).otherwise(F.lit(o)) for x, o in ((su_cosb, 1.0), (su_sinb, 0.0)))
    if proj == "SZP":
        mu, phi, theta = _opt(df, "pv2_1"), F.radians(_opt(df, "pv2_2")), F.radians(_opt(df, "pv2_3", 90.0))
        xp, yp, zp = -mu * F.cos(theta) * F.sin(phi), mu * F.cos(theta) * F.cos(phi), mu * F.sin(theta) + 1
        s = 1.0 - cosu
        return F.degrees((zp * su_sinb - xp * s) / (zp - s)), F.degrees(-(zp * su_cosb + yp * s) / (zp - s))
    if proj == "ZEA":
        r = F.sqrt(2 * (1 - cosu))
    elif proj == "ARC":
        r = u
    elif proj == "ZPN":
        r = sum((_opt(df, f"pv2_{n}", 1.0 if n == 1 else 0.0) * F.pow(u, F.lit(n)) for n in range(10)), F.lit(0.0))
    elif proj == "AZP":
        mu, gamma = _opt(df, "pv2_1"), F.radians(_opt(df, "pv2_2"))
        t = mu + cosu + su_cosb * F.tan(gamma)
        r = (mu + 1.0) * sinu / F.when(F.abs(t) < 1e-10, 1e-10).otherwise(t)
    else:
        raise ValueError(f"unknown projection {proj}")
    return F.degrees(-r * cosb), F.degrees(r * sinb)


def sip(x: Column, y: Column, a: str, order: int) -> Column:
    """Sum of a[i][j] x^i y^j, 0 < i + j <= order, of a map column ``'i_j' -> coefficient``."""
    terms = [F.coalesce(F.try_element_at(F.col(a), F.lit(f"{i}_{j}")), F.lit(0.0)) * F.pow(x, F.lit(i)) * F.pow(y, F.lit(j)) for i in range(order + 1) for j in range(order + 1 - i) if i + j]
    return sum(terms[1:], terms[0])


def apply_sip(df: DataFrame, x: str, y: str, a: str = "sip_a", b: str = "sip_b", order: int = 3) -> DataFrame:
    """X + sum A_ij x^i y^j and y + sum B_ij x^i y^j, of map columns ``'i_j' -> coefficient``."""
    return df.withColumns({x: F.col(x) + sip(F.col(x), F.col(y), a, order), y: F.col(y) + sip(F.col(x), F.col(y), b, order)})


def world2pix(df: DataFrame, proj: str = "TAN", ra: str = "radeg", dec: str = "decdeg", out: tuple[str, str] = ("pix_x", "pix_y"), sip_order: int = 0) -> DataFrame:
    """Pixel positions by the row's WCS columns crval1/2, crpix1/2, cd1_1.. (and pv2_n, sip_a, sip_b). Null where
    the projection has no value."""
    x1, y1 = plane(df, proj, F.col(ra), F.col(dec))
    det = F.col("cd1_1") * F.col("cd2_2") - F.col("cd2_1") * F.col("cd1_2")
    x, y = (F.col("cd2_2") * x1 - F.col("cd1_2") * y1) / det, (F.col("cd1_1") * y1 - F.col("cd2_1") * x1) / det
    df = df.withColumns({out[0]: x, out[1]: y})
    if sip_order:
        df = apply_sip(df, *out, order=sip_order)
    return df.withColumns({out[0]: F.col(out[0]) + F.col("crpix1"), out[1]: F.col(out[1]) + F.col("crpix2")})


def pix2world(df: DataFrame, proj: str = "TAN", x: str = "x_image", y: str = "y_image", out: tuple[str, str] = ("alpha_j2000", "delta_j2000"), steps: int = 6) -> DataFrame:
    """Sky positions of pixels; TAN, ZEA and ARC in closed form, ZPN by ``steps`` unrolled Newton steps."""
    dx, dy = F.col(x) - F.col("crpix1"), F.col(y) - F.col("crpix2")
    x1 = F.radians(F.col("cd1_1") * dx + F.col("cd1_2") * dy)
    y1 = F.radians(F.col("cd2_1") * dx + F.col("cd2_2") * dy)
    df = df.withColumns({"_x1": x1, "_y1": y1})
    x1, y1, d0 = F.col("_x1"), F.col("_y1"), F.radians(F.col("crval2"))
    if proj == "TAN":
        a = F.atan2(x1, F.cos(d0) - y1 * F.sin(d0))
        d = F.asin(clamp((F.sin(d0) + y1 * F.cos(d0)) / F.sqrt(1 + x1 * x1 + y1 * y1)))
        return df.withColumns({out[0]: F.pmod(F.col("crval1") + F.degrees(a), F.lit(360.0)), out[1]: F.degrees(d)}).drop("_x1", "_y1")
    df = df.withColumn("_r", F.sqrt(x1 * x1 + y1 * y1))
    r = F.col("_r")
    if proj == "ZEA":
        u = 2 * F.asin(clamp(r / 2))
    elif proj == "ARC":
        u = r
    elif proj == "ZPN":
        p = [_opt(df, f"pv2_{n}", 1.0 if n == 1 else 0.0) for n in range(10)]
        df = df.withColumn("_u", r)
        for _ in range(steps):
            v = F.col("_u")
            value = sum((p[n] * F.pow(v, F.lit(n)) for n in range(1, 10)), p[0]) - r
            slope = sum((n * p[n] * F.pow(v, F.lit(n - 1)) for n in range(2, 10)), p[1])
            df = df.withColumn("_u", v - value / slope)
        u = F.col("_u")
    else:
        raise ValueError(f"no inverse of {proj}")
    cosb, sinb = (F.when(r > 0, c / F.when(r > 0, r)).otherwise(F.lit(o)) for c, o in ((-F.col("_x1"), 1.0), (F.col("_y1"), 0.0)))
    d = F.asin(clamp(F.cos(u) * F.sin(d0) + F.sin(u) * sinb * F.cos(d0)))
    a = F.atan2(-F.sin(u) * cosb, F.cos(u) * F.cos(d0) - F.sin(u) * sinb * F.sin(d0))
    ra = F.col("crval1") + F.degrees(a)
    wrapped = ra - 360.0 * F.floor(ra / 360.0)
    return df.withColumns({out[0]: wrapped, out[1]: F.degrees(d)}).drop("_x1", "_y1", "_r", "_u")


def image_geometry(images: DataFrame) -> DataFrame:
    """Adds pixel_scale (degrees; of CD, else CDELT, else 0.7 arcsec), centre_x, centre_y, diagonal (degrees)
    and field_radius (half of it)."""
    cd = F.sqrt(F.abs(F.col("cd1_1") * F.col("cd2_2") - F.col("cd1_2") * F.col("cd2_1"))) if "cd1_1" in images.columns else F.lit(None).cast("double")
    cdelt = F.abs(F.col("cdelt1")) if "cdelt1" in images.columns else F.lit(None).cast("double")
    scale = F.coalesce(F.when(cd > 0, cd), F.when(cdelt > 0, cdelt), F.lit(0.7 / 3600))
    diagonal = F.sqrt(F.pow("imgaxis1", F.lit(2)) + F.pow("imgaxis2", F.lit(2))) * F.col("pixel_scale")
    return images.withColumns({"pixel_scale": scale, "centre_x": F.col("imgaxis1") / 2.0, "centre_y": F.col("imgaxis2") / 2.0}).withColumns({"diagonal": diagonal, "field_radius": diagonal / 2})


def _rotation(node: float, pole_ra: float, pole_dec: float) -> list[list[float]]:
    """Rows of the matrix to a frame whose pole and longitude of the north pole are given, in degrees."""
    a, d, n = map(math.radians, (pole_ra, pole_dec, node))
    z = [math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)]
    east = [-math.sin(a), math.cos(a), 0.0]
    north = [-math.sin(d) * math.cos(a), -math.sin(d) * math.sin(a), math.cos(d)]
    x = [math.cos(n) * p + math.sin(n) * q for p, q in zip(north, east)]
    y = [math.sin(n) * p - math.cos(n) * q for p, q in zip(north, east)]
    return [x, y, z]


#: Poles (RA, Dec) and longitude of the celestial pole of the galactic and ecliptic frames.
FRAMES = {"icrs": None, "galactic": _rotation(122.93192, 192.85948, 27.12825), "ecliptic": _rotation(90.0, 270.0, 90.0 - 23.4392911)}


def convert_coords(df: DataFrame, src: str, dst: str, lon: str = "radeg", lat: str = "decdeg", out: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """Longitude and latitude between icrs, galactic and ecliptic, by one 3x3 rotation."""
    unit = [[float(i == j) for j in range(3)] for i in range(3)]
    a, b = FRAMES[src] or unit, FRAMES[dst] or unit
    m = [[sum(b[i][k] * a[j][k] for k in range(3)) for j in range(3)] for i in range(3)]  # b . a^T
    l, p = F.radians(F.col(lon)), F.radians(F.col(lat))
    v = [F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)]
    x, y, z = (row[0] * v[0] + row[1] * v[1] + row[2] * v[2] for row in m)
    turned = F.degrees(F.atan2(y, x))
    return df.withColumns({out[0]: turned - 360.0 * F.floor(turned / 360.0), out[1]: F.degrees(F.asin(clamp(z)))})


def offscale(df: DataFrame, x: str = "pix_x", y: str = "pix_y") -> DataFrame:
    """Adds offscale: 1 where the projection gives no position, 2 outside the image, else 0."""
    none = F.col(x).isNull() | F.col(y).isNull() | F.isnan(x) | F.isnan(y)
    outside = (F.col(x) < 0.5) | (F.col(y) < 0.5) | (F.col(x) > F.col("imgaxis1") + 0.5) | (F.col(y) > F.col("imgaxis2") + 0.5)
    return df.withColumn("offscale", F.when(none, 1).when(outside, 2).otherwise(0))


def bjd(images: DataFrame, ra: str = "objra", dec: str = "objdec") -> DataFrame:
    """Adds bjd, the JD plus the light's way from the barycentre along the target; earth_x.. are columns."""
    a, d = F.radians(F.col(ra)), F.radians(F.col(dec))
    way = F.col("earth_x") * F.cos(d) * F.cos(a) + F.col("earth_y") * F.cos(d) * F.sin(a) + F.col("earth_z") * F.sin(d)
    return images.withColumn("bjd", F.col("jd") + way * LIGHT_DAYS_PER_AU)


def astrometric_row(df: DataFrame) -> DataFrame:
    """Adds ra_err, dec_err, fwhm_arcsec (arcsec) and snr. Errors are sqrt(astsigma^2 / 2 + max(astvar, 0) * v) in
    pixels, v the axis's variance (0.01 where it is missing or negative); snr is 0 for an error outside 0..10."""
    scale = F.col("pixel_scale") * 3600

    def error(column: str) -> Column:
        v = F.when(F.col(column) >= 0, F.col(column)).otherwise(F.lit(0.01))
        floor = F.pow(F.coalesce("astsigma", F.lit(0.0)), F.lit(2)) / 2
        return F.sqrt(floor + F.greatest(F.coalesce("astvar", F.lit(1.0)), F.lit(0.0)) * v) * scale

    e = F.col("magerr_calib")
    snr = F.when((e > 0) & (e < 10), 1.086 / F.when(e > 0, e)).otherwise(F.lit(0.0))
    return df.withColumns({"ra_err": error("errx2_image"), "dec_err": error("erry2_image"), "fwhm_arcsec": F.col("fwhm_image") * scale, "snr": snr})

"""B: projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import sql, view
from ..functions import astrom, bands, headers, response
from . import query


def rounded(df, *columns: str, n: int = 6, keep: tuple[str, ...] = ()):
    return df.select(*keep, *[F.round(c, n).alias(c) for c in columns])


@query("b01_sloan_to_johnson", """select star_id, round(sloan_r+1.490989*gr+0.125787*gr*gr-0.022359*gr*gr*gr+0.186304,6) as johnson_b, round(sloan_r+0.510236*gr-0.0337082,6) as johnson_v,
 round(sloan_r-0.197420*ri-0.083113*ri*ri-0.179943,6) as johnson_r, round(sloan_r-0.897087*ri-0.575316*iz-0.423971,6) as johnson_i
 from (select *, sloan_g-sloan_r as gr, sloan_r-sloan_i as ri, sloan_i-sloan_z as iz from fx_stars)""")  # fmt: skip
def b01(spark, d):
    return rounded(bands.sloan_to_johnson(view(spark, d, "fx_stars")), "johnson_b", "johnson_v", "johnson_r", "johnson_i", keep=("star_id",))


@query("b02_gaia_to_johnson", """select star_id, round(bp+0.0085+0.666169*e+0.145798*e*e+0.517584*e*e*e,6) as johnson_b, round(g+0.0052+0.368628*c+0.139117*c*c-0.103787*e+0.194751*e*e+0.156161*e*e*e,6) as johnson_v,
 round(g+0.0167-0.036933*c-0.083075*c*c+0.022532*c*c*c-0.353593*e-0.482768*e*e+0.728803*e*e*e,6) as johnson_r, round(rp-0.0660-0.395266*c+0.183776*c*c-0.020945*c*c*c+0.253449*e-0.113991*e*e,6) as johnson_i
 from (select star_id, sloan_r as g, sloan_g as bp, sloan_i as rp, sloan_g-sloan_r as c, sloan_r-sloan_i as e from fx_stars)""")  # fmt: skip
def b02(spark, d):
    stars = view(spark, d, "fx_stars").select("star_id", F.col("sloan_r").alias("g"), F.col("sloan_g").alias("bp"), F.col("sloan_i").alias("rp"))
    return rounded(bands.gaia_to_johnson(stars), "johnson_b", "johnson_v", "johnson_r", "johnson_i", keep=("star_id",))


@query("b03_atlas_co", "select star_id, round(sloan_g-0.467*(sloan_g-sloan_r)-0.048*power(sloan_g-sloan_r,2),6) as cyan, round(sloan_r-0.443*(sloan_r-sloan_i)-0.090*power(sloan_r-sloan_i,2),6) as orange from fx_stars")
def b03(spark, d):
    return rounded(bands.atlas_co(view(spark, d, "fx_stars")), "cyan", "orange", keep=("star_id",))


@query("b04_j_vega", "select star_id, round(j-0.894,6) as j_vega from fx_stars")
def b04(spark, d):
    return rounded(bands.j_vega(view(spark, d, "fx_stars")), "j_vega", keep=("star_id",))


@query("b05_schema_colors", "select star_id, round(sloan_g-sloan_r,6) as color1, round(sloan_r-sloan_i,6) as color2, round(sloan_i-sloan_g,6) as color3, round(sloan_g-sloan_r,6) as color4 from fx_stars")
def b05(spark, d):
    return rounded(bands.schema_colors(view(spark, d, "fx_stars"), ["sloan_g", "sloan_r", "sloan_i"]), "color1", "color2", "color3", "color4", keep=("star_id",))


@query("b06_mag_err", """select star_id, round(case when snr=0 then null else 2.5/(snr*ln(10.0)) end,6) as mag_err, round(case when poe=0 then 0 else coalesce(parallax,0)/poe end,6) as parallax_err
 from (select star_id, parallax, (star_id%50)*1.0e0 as snr, coalesce(case when star_id%7=0 then null else (star_id%11)*1.0e0 end, 1.0e0) as poe from fx_stars)""")  # fmt: skip
def b06(spark, d):
    stars = sql(spark, d, "select star_id, parallax, (star_id%50)*1.0e0 as snr, case when star_id%7=0 then null else (star_id%11)*1.0e0 end as poe from fx_stars")
    return rounded(stars.withColumns({"mag_err": bands.mag_err_from_snr(F.col("snr")), "parallax_err": bands.parallax_err(F.col("parallax"), F.col("poe"))}), "mag_err", "parallax_err", keep=("star_id",))


@query("b07_fill_mag_err", "select star_id, case when sloan_r<19 then 0.1e0 else 0.2e0 end as r_err, round(0.01e0*(star_id%5),6) as g_err from fx_stars")
def b07(spark, d):
    stars = sql(spark, d, "select star_id, sloan_r, sloan_g, 0.0e0 as r_err, 0.01e0*(star_id%5) as g_err from fx_stars")
    return rounded(bands.fill_mag_err(stars, {"sloan_r": "r_err", "sloan_g": "g_err"}), "r_err", "g_err", keep=("star_id",))


@query("b08_zero_nulls", "select star_id, coalesce(case when star_id%3=0 then null else pmra end,0) as pmra, case when star_id%5=0 then 0 else pmdec end as pmdec, 0.0e0 as parallax from fx_stars")
def b08(spark, d):
    stars = sql(spark, d, "select star_id, case when star_id%3=0 then null else pmra end as pmra, case when star_id%5=0 then double('NaN') else pmdec end as pmdec from fx_stars")
    return bands.zero_nulls(stars)


@query("b09_apply_pm", """select image_id, star_id, round(radeg+pmra*(jd-2457204.5)/365.2425,9) as radeg, round(decdeg+pmdec*(jd-2457204.5)/365.2425,9) as decdeg
 from fx_stars join fx_images on star_id%(select count(*) from fx_images)=image_id""")  # fmt: skip
def b09(spark, d):
    rows = sql(spark, d, "select * from fx_stars join fx_images on star_id%(select count(*) from fx_images)=image_id")
    return rounded(astrom.apply_pm(rows), "radeg", "decdeg", n=9, keep=("image_id", "star_id"))


_EARTH = """e as (select *, -r*cos(lon) as ex, -r*sin(lon)*cos(tilt) as ey, -r*sin(lon)*sin(tilt) as ez from (select *, radians(280.459+0.98564736*n)+radians(1.915*sin(g)+0.020*sin(2*g)) as lon,
 1.00014-0.01671*cos(g)-0.00014*cos(2*g) as r, radians(23.439-0.00000036*n) as tilt from (select *, radians(357.529+0.98560028*n) as g from (select *, jd-2451545.0 as n from fx_images))))"""


@query("b10_parallax", f"""with {_EARTH} select image_id, star_id, round(radeg+case when parallax>0 then parallax/1000*(ey*cos(radians(radeg))-ex*sin(radians(radeg)))/cos(radians(decdeg))/3600 else 0 end,9) as radeg,
 round(decdeg+case when parallax>0 then parallax/1000*(ez*cos(radians(decdeg))-ex*cos(radians(radeg))*sin(radians(decdeg))-ey*sin(radians(radeg))*sin(radians(decdeg)))/3600 else 0 end,9) as decdeg
 from fx_stars join e on star_id%(select count(*) from fx_images)=image_id""")  # fmt: skip
def b10(spark, d):
    images = astrom.with_earth(view(spark, d, "fx_images").select("image_id", "jd"))
    stars = sql(spark, d, "select *, star_id%(select count(*) from fx_images) as image_id from fx_stars")
    rows = stars.join(images, "image_id")
    return rounded(astrom.apply_parallax(rows), "radeg", "decdeg", n=9, keep=("image_id", "star_id"))


@query("b11_airmass", "select image_id, round(1.0/(cos(z)+0.025*exp(-11.0*cos(z))),6) as airmass from (select image_id, radians((image_id*7)%90) as z from fx_images)")
def b11(spark, d):
    rows = view(spark, d, "fx_images").withColumn("airmass", astrom.airmass(F.radians((F.col("image_id") * 7) % 90)))
    return rounded(rows, "airmass", keep=("image_id",))


@query("b12_star_airmass", """select image_id, star_id, round(case when image_id%4=3 then 1.0 when a<0 or a>10 then 1.0 else a end,6) as airmass_abs, round(case when image_id%4=3 then 0.0 else (case when a<0 or a>10 then 1.0 else a end)-1.1 end,6) as adif
 from (select *, 1.0/(sin(alt)+0.025*exp(-11.0*sin(alt))) as a from (select image_id, star_id, asin(greatest(-1,least(1,sin(radians(lat))*sin(radians(decdeg))+cos(radians(lat))*cos(radians(decdeg))*cos(radians(280.46061837+360.98564736629*(jd-2451545.0)+14.78-radeg))))) as alt
 from (select *, 49.9e0 as lat from fx_stars join fx_images on star_id%(select count(*) from fx_images)=image_id)))""")  # fmt: skip
def b12(spark, d):
    rows = sql(spark, d, "select *, case when image_id%4=3 then null else 49.9e0 end as latitude, 14.78e0 as longitud, 1.1e0 as airmass from fx_stars join fx_images on star_id%(select count(*) from fx_images)=image_id")
    return rounded(astrom.star_airmass(rows), "airmass_abs", "adif", keep=("image_id", "star_id"))


def _wcs(spark, d, where: str = ""):
    return sql(spark, d, f"select *, 150.0e0 as crval1, 20.0e0 as crval2, 1000.0e0 as crpix1, 1000.0e0 as crpix2, -0.0003e0 as cd1_1, 0.0e0 as cd1_2, 0.0e0 as cd2_1, 0.0003e0 as cd2_2, 2000 as imgaxis1, 2000 as imgaxis2 from fx_stars {where}")


@query("b13_world2pix_tan", "select star_id, round(cat_x,5) as pix_x, round(cat_y,5) as pix_y from fx_stars")
def b13(spark, d):
    return rounded(astrom.world2pix(_wcs(spark, d)), "pix_x", "pix_y", n=5, keep=("star_id",))


def _proj_sql(r: str) -> str:
    return f"""with n as (select star_id, sin(radians(decdeg))*sin(radians(20.0))+cos(radians(decdeg))*cos(radians(20.0))*cos(radians(radeg-150.0)) as cu, -cos(radians(decdeg))*sin(radians(radeg-150.0)) as sc,
 sin(radians(decdeg))*cos(radians(20.0))-cos(radians(decdeg))*sin(radians(20.0))*cos(radians(radeg-150.0)) as ss from fx_stars), u as (select *, sqrt(sc*sc+ss*ss) as su, atan2(sqrt(sc*sc+ss*ss),cu) as u from n)
 select star_id, round(1000.0+degrees(-({r})*sc/su)/(-0.0003),5) as pix_x, round(1000.0+degrees(({r})*ss/su)/0.0003,5) as pix_y from u where su>0"""


@query("b13_world2pix_zea", _proj_sql("sqrt(2*(1-cu))"))
def b13_zea(spark, d):
    return rounded(astrom.world2pix(_wcs(spark, d), "ZEA"), "pix_x", "pix_y", n=5, keep=("star_id",))


@query("b13_world2pix_arc", _proj_sql("u"))
def b13_arc(spark, d):
    return rounded(astrom.world2pix(_wcs(spark, d), "ARC"), "pix_x", "pix_y", n=5, keep=("star_id",))


@query("b13_world2pix_zpn", _proj_sql("u+0.5*u*u*u"))
def b13_zpn(spark, d):
    return rounded(astrom.world2pix(_wcs(spark, d).withColumns({"pv2_1": F.lit(1.0), "pv2_3": F.lit(0.5)}), "ZPN"), "pix_x", "pix_y", n=5, keep=("star_id",))


@query("b13_world2pix_azp", _proj_sql("3.0*su/(2.0+cu+sc*tan(radians(5.0)))"))
def b13_azp(spark, d):
    return rounded(astrom.world2pix(_wcs(spark, d).withColumns({"pv2_1": F.lit(2.0), "pv2_2": F.lit(5.0)}), "AZP"), "pix_x", "pix_y", n=5, keep=("star_id",))


@query("b13_world2pix_szp", """with n as (select star_id, sin(radians(decdeg))*sin(radians(20.0))+cos(radians(decdeg))*cos(radians(20.0))*cos(radians(radeg-150.0)) as cu, -cos(radians(decdeg))*sin(radians(radeg-150.0)) as sc,
 sin(radians(decdeg))*cos(radians(20.0))-cos(radians(decdeg))*sin(radians(20.0))*cos(radians(radeg-150.0)) as ss from fx_stars),
 p as (select *, -2.0*cos(radians(60.0))*sin(radians(180.0)) as xp, 2.0*cos(radians(60.0))*cos(radians(180.0)) as yp, 2.0*sin(radians(60.0))+1 as zp, 1.0-cu as s from n)
 select star_id, round(1000.0+degrees((zp*ss-xp*s)/(zp-s))/(-0.0003),5) as pix_x, round(1000.0+degrees(-(zp*sc+yp*s)/(zp-s))/0.0003,5) as pix_y from p""")  # fmt: skip
def b13_szp(spark, d):
    return rounded(astrom.world2pix(_wcs(spark, d).withColumns({"pv2_1": F.lit(2.0), "pv2_2": F.lit(180.0), "pv2_3": F.lit(60.0)}), "SZP"), "pix_x", "pix_y", n=5, keep=("star_id",))


@query("b14_apply_sip", """select star_id, round(x+1e-6*x*x-2e-6*x*y,6) as x, round(y+3e-9*x*x*x+5e-6*y*y,6) as y from (select star_id, cat_x-1000 as x, cat_y-1000 as y from fx_stars)""")
def b14(spark, d):
    rows = sql(spark, d, "select star_id, cat_x-1000 as x, cat_y-1000 as y, map('2_0', 1e-6, '1_1', -2e-6) as sip_a, map('3_0', 3e-9, '0_2', 5e-6) as sip_b from fx_stars")
    return rounded(astrom.apply_sip(rows, "x", "y"), "x", "y", keep=("star_id",))


@query("b15_pix2world_tan", "select star_id, round(radeg,9) as alpha_j2000, round(decdeg,9) as delta_j2000 from fx_stars")
def b15(spark, d):
    return rounded(astrom.pix2world(_wcs(spark, d), "TAN", "cat_x", "cat_y"), "alpha_j2000", "delta_j2000", n=9, keep=("star_id",))


for _proj, _pv in (("ZEA", {}), ("ARC", {}), ("ZPN", {"pv2_1": 1.0, "pv2_3": 0.5})):

    @query(f"b15_roundtrip_{_proj.lower()}", "select star_id, round(cat_x,4) as pix_x, round(cat_y,4) as pix_y from fx_stars")
    def b15_roundtrip(spark, d, proj=_proj, pv=_pv):
        rows = _wcs(spark, d).withColumns({k: F.lit(v) for k, v in pv.items()})
        sky = astrom.pix2world(rows, proj, "cat_x", "cat_y", ("_a", "_d"))
        return rounded(astrom.world2pix(sky, proj, "_a", "_d"), "pix_x", "pix_y", n=4, keep=("star_id",))


@query("b16_image_geometry", """select image_id, round(s,9) as pixel_scale, imgaxis1/2.0e0 as centre_x, imgaxis2/2.0e0 as centre_y, round(s*sqrt(imgaxis1*imgaxis1+imgaxis2*imgaxis2),6) as diagonal, round(s*sqrt(imgaxis1*imgaxis1+imgaxis2*imgaxis2)/2,6) as field_radius
 from (select *, case image_id%3 when 0 then 0.0003e0 when 1 then 0.0002e0 else 0.7e0/3600 end as s from fx_images)""")  # fmt: skip
def b16(spark, d):
    rows = sql(spark, d, "select *, case when image_id%3=0 then -0.0003e0 end as cd1_1, 0.0e0 as cd1_2, 0.0e0 as cd2_1, 0.0003e0 as cd2_2, case when image_id%3=1 then -0.0002e0 end as cdelt1 from fx_images")
    return rounded(astrom.image_geometry(rows), "pixel_scale", "centre_x", "centre_y", "diagonal", "field_radius", n=9, keep=("image_id",)).withColumns({c: F.round(c, 6) for c in ("diagonal", "field_radius")})


_GAL = """with v as (select star_id, cos(radians(decdeg))*cos(radians(radeg)) as x, cos(radians(decdeg))*sin(radians(radeg)) as y, sin(radians(decdeg)) as z, radians(radeg) as a, radians(decdeg) as d, radians(192.85948) as ap, radians(27.12825) as dp from fx_stars)
 select star_id, round((122.93192-degrees(atan2(cos(d)*sin(a-ap), sin(d)*cos(dp)-cos(d)*sin(dp)*cos(a-ap)))+720.0)%360.0,6) as lon, round(degrees(asin(sin(d)*sin(dp)+cos(d)*cos(dp)*cos(a-ap))),6) as lat from v"""


@query("b17_galactic", _GAL)
def b17(spark, d):
    return rounded(astrom.convert_coords(view(spark, d, "fx_stars"), "icrs", "galactic"), "lon", "lat", keep=("star_id",))


@query("b17_ecliptic", """select star_id, round((degrees(atan2(sin(a)*cos(e)+tan(d)*sin(e),cos(a)))+360.0)%360.0,6) as lon, round(degrees(asin(sin(d)*cos(e)-cos(d)*sin(e)*sin(a))),6) as lat from (select star_id, radians(radeg) as a, radians(decdeg) as d, radians(23.4392911) as e from fx_stars)""")
def b17_ecliptic(spark, d):
    return rounded(astrom.convert_coords(view(spark, d, "fx_stars"), "icrs", "ecliptic"), "lon", "lat", keep=("star_id",))


@query("b17_offscale", "select star_id, case when cat_x+0.03<0.5 or cat_y+0.03<0.5 or cat_x+0.03>1500.5 or cat_y+0.03>1500.5 then 2 else 0 end as offscale from fx_stars")
def b17_offscale(spark, d):
    return astrom.offscale(astrom.world2pix(_wcs(spark, d).withColumns({"imgaxis1": F.lit(1500), "imgaxis2": F.lit(1500), "crpix1": F.lit(1000.03), "crpix2": F.lit(1000.03)}))).select("star_id", "offscale")


@query("b18_parse_coord", """select star_id, round(radeg,7) as ra, round(decdeg,7) as dec from (select star_id, (floor(h)+floor((h-floor(h))*60)/60+round(((h-floor(h))*60-floor((h-floor(h))*60))*60,3)/3600)*15 as radeg,
 -(floor(decdeg)+floor((decdeg-floor(decdeg))*60)/60+round(((decdeg-floor(decdeg))*60-floor((decdeg-floor(decdeg))*60))*60,2)/3600) as decdeg from (select star_id, radeg/15 as h, decdeg from fx_stars))""")  # fmt: skip
def b18(spark, d):
    text = view(spark, d, "fx_stars").withColumns({"a": headers.format_coord(F.col("radeg"), True, 3), "b": headers.format_coord(-F.col("decdeg"), False, 2)})
    rows = text.withColumns({"ra": headers.parse_coord(F.col("a"), True), "dec": headers.parse_coord(F.col("b"))})
    return rounded(rows, "ra", "dec", n=7, keep=("star_id",))


@query("b19_normalize_filter", "select image_id, case filter when 'r' then 'Sloan_r' else filter end as filter from fx_images")
def b19(spark, d):
    return view(spark, d, "fx_images").select("image_id", headers.normalize_filter(F.col("filter")).alias("filter"))


@query("b20_reconcile_time", """select image_id, round(case when image_id%3=0 then jd+0.5 else jd end,6) as jd, round(case when image_id%3=0 then jd+0.5 else jd end-2400000.5,6) as mjd_obs, case when image_id%3=0 then 'ux/jd' else '' end as time_conflicts from fx_images""")
def b20(spark, d):
    rows = sql(spark, d, "select image_id, jd, case when image_id%3=0 then (jd+0.5-2440587.5)*86400 end as ctime, 0 as usec from fx_images")
    return rounded(headers.reconcile_time(rows), "jd", "mjd_obs", keep=("image_id", "time_conflicts"))


@query("b21_bjd", f"with {_EARTH} select image_id, round(jd+(ex*cos(radians(ctrdec))*cos(radians(ctrra))+ey*cos(radians(ctrdec))*sin(radians(ctrra))+ez*sin(radians(ctrdec)))*499.004783836/86400,7) as bjd from e")
def b21(spark, d):
    return rounded(astrom.bjd(astrom.with_earth(view(spark, d, "fx_images")), "ctrra", "ctrdec"), "bjd", n=7, keep=("image_id",))


@query("b22_image_defaults", """select image_id, case when image_id%2=0 then 10.0e0 else 49.9090806e0 end as latitude, 14.7819092e0 as longitud, 530.0e0 as altitude, case image_id%3 when 0 then 'A1' when 1 then 'unknown' else 'unknown' end as chip_id,
 cast(image_id as varchar)||'.'||lpad(cast(image_id%20 as varchar),2,'0') as obsid, exptime, 1.0e0 as airmass, -100.0e0 as objra, -100.0e0 as objdec, ctrx, ctry from fx_images""")  # fmt: skip
def b22(spark, d):
    rows = sql(spark, d, "select image_id, exptime, ctrx, ctry, imgaxis1, imgaxis2, case when image_id%2=0 then 10.0e0 end as tel_lat, case image_id%3 when 0 then 'A1' when 1 then '' end as ccd_ser, '' as ccd_type, image_id as obsid_n, image_id%20 as scriprep from fx_images")
    return headers.image_defaults(rows).select("image_id", "latitude", "longitud", "altitude", "chip_id", "obsid", "exptime", "airmass", "objra", "objdec", "ctrx", "ctry")


@query("b23_soften_errors", "select image_id, number, round(sqrt(magerr_auto*magerr_auto+0.0005*0.0005),7) as magerr_auto, round(sqrt(magerr_auto*magerr_auto+0.0004),7) as dy, round(sqrt(errx2_image*errx2_image+erry2_image*erry2_image+2.5e-5),7) as image_dxy, round(errx2_image+erry2_image,7) as image_var from fx_det")
def b23(spark, d):
    return rounded(headers.soften_errors(view(spark, d, "fx_det")), "magerr_auto", "dy", "image_dxy", "image_var", n=7, keep=("image_id", "number"))


@query("b24_estimate_maglimit", "select image_id, round((log10(1000.0/(field*field))+case when image_id%90<20 then 3.5 when image_id%90<40 then 3.8 else 4.0 end)/0.6,6) as maglimit from fx_images")
def b24(spark, d):
    return rounded(view(spark, d, "fx_images").withColumn("maglimit", headers.estimate_maglimit(F.col("field"), F.lit(1000.0), -(F.col("image_id") % 90))), "maglimit", keep=("image_id",))


@query("b25_powerlaw_mag", "select image_id, round(case when jd>2460311.0 then 15.0+1.2*2.5*log10(jd-2460311.0) end,6) as mag from fx_images")
def b25(spark, d):
    return rounded(view(spark, d, "fx_images").withColumn("mag", headers.powerlaw_mag(F.col("jd"), 2460311.0, 15.0, 1.2)), "mag", keep=("image_id",))


MODEL = {"Z": 22.1, "PX": -0.02, "PY": 0.03, "PXY": 0.004, "P2R": 0.001, "PC": 0.05, "SX": 0.01, "PX:3": 0.1, "RS": 0.001, "RO": 2.0, "RC": 0.01, "XC": 0.4, "GA": 0.02, "GW": 1.0, "EA": 0.01, "EW": 2.0}
_PAIR = "d.*, s.star_id, s.cat_x, s.cat_y, s.sloan_g-s.sloan_r as color1, s.sloan_r-s.sloan_i as color2, s.sloan_i-s.sloan_z as color3, (d.x_image-1000.0e0)/1024 as coord_x, (d.y_image-1000.0e0)/1024 as coord_y from fx_det d join fx_stars s on s.star_id=d.true_star_id"


@query("b26_eval_response", f"""select image_id, number, round(mag_auto+22.1-0.02*x+0.03*y+0.004*x*y+0.001*(x*x+y*y)*(x*x+y*y)+0.05*color1+0.01*sin(pi()*(cat_x-floor(cat_x)))+case when image_id=3 then 0.1*x else 0 end+0.4*color2
 +0.02*exp(-(x*x+y*y)*25/10)+0.01*(exp(sqrt((x*x+y*y)/2))/(sqrt((x*x+y*y)/2)+1)-1)+0.001*q/(1+0.01*q*q+1e-10),6) as mag_model from (select *, coord_x as x, coord_y as y, -(mag_auto+10)-2.0 as q from (select {_PAIR}))""")  # fmt: skip
def b26(spark, d):
    return rounded(response.eval_response(sql(spark, d, f"select /*+ shuffle_hash(s) */ {_PAIR}"), MODEL), "mag_model", keep=("image_id", "number"))


@query("b28_apply_spatial", f"select image_id, number, round(mag_auto-0.020317*coord_x+0.030713*coord_y+0.5*0.01*(image_id%3)*coord_x*coord_x,6) as mag_flat from (select {_PAIR})")
def b28(spark, d):
    rows = sql(spark, d, f"select /*+ shuffle_hash(s) */ {_PAIR}").withColumn("response", F.format_string("FILTER=Sloan_r,SCHEMA=SloanJ,Z=22.5,PX=-0.020317,PY=0.030713,P2X=%.4f", 0.5 * 0.01 * (F.col("image_id") % 3)))
    rows = rows.withColumn("terms", response.response_terms(F.col("response")))
    return rounded(response.eval_response(rows, "terms", out="mag_flat", skip=("Z", "XC", "SC")), "mag_flat", keep=("image_id", "number"))


@query("b29_instrument_mag", "select star_id, round(sloan_r-(22.1+0.05*(sloan_g-sloan_r)+0.4*(sloan_r-sloan_i)),6) as instrument_mag, round(0.05*(sloan_g-sloan_r)+0.4*(sloan_r-sloan_i)-(0.05*0.5+0.4*0.2),6) as correction from fx_stars")
def b29(spark, d):
    from ..operators.color import differential_correction, instrument_mag

    stars = bands.schema_colors(view(spark, d, "fx_stars"), ["sloan_g", "sloan_r", "sloan_i", "sloan_z", "j"])
    model = {"Z": 22.1, "PC": 0.05, "XC": 0.4}
    return rounded(differential_correction(instrument_mag(stars, model, "sloan_r"), model, (0.5, 0.2, 0.1, 0.1)), "instrument_mag", "correction", keep=("star_id",))


@query("b32_astrometric_row", """select image_id, number, round(sqrt(power(0.2+0.01*(image_id%5),2)/2+4.0*errx2_image)*1.08,6) as ra_err, round(sqrt(power(0.2+0.01*(image_id%5),2)/2+4.0*erry2_image)*1.08,6) as dec_err, round(fwhm_image*1.08,6) as fwhm_arcsec, round(1.086/magerr_auto,6) as snr from fx_det""")
def b32(spark, d):
    rows = view(spark, d, "fx_det").join(view(spark, d, "fx_images").select("image_id", "astsigma", "astvar"), "image_id").withColumns({"pixel_scale": F.lit(0.0003), "magerr_calib": F.col("magerr_auto")})
    return rounded(astrom.astrometric_row(rows), "ra_err", "dec_err", "fwhm_arcsec", "snr", keep=("image_id", "number"))


@query("e25_sum_mag", "select image_id, round(-2.5*log10(sum(power(10.0,-0.4*mag_auto))),6) as mag from fx_det group by image_id")
def e25(spark, d):
    return view(spark, d, "fx_det").groupBy("image_id").agg(F.round(bands.sum_mag(F.col("mag_auto")), 6).alias("mag"))



"""D: position joins; the flagship calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import BY_STAR, sql, view
from ..operators import calib, match
from ..plans import pipelines
from . import query

#: All neighbours within 40 pixels by brute force; the cell join must give just these.
_NEAR = "n as (select d.image_id, d.number, s.star_id, sqrt(power(d.x_image-s.cat_x,2)+power(d.y_image-s.cat_y,2)) as dist from fx_det d join fx_stars0 s on abs(d.x_image-s.cat_x)<={r} and abs(d.y_image-s.cat_y)<={r} where sqrt(power(d.x_image-s.cat_x,2)+power(d.y_image-s.cat_y,2))<={r})"
_PAIRS = _NEAR.format(r="2.003") + """, p as (select d.*, n.star_id, n.dist, s.sloan_g, s.sloan_r, s.sloan_i, s.sloan_z, s.j, s.cat_x, s.cat_y, s.sloan_r as cat_mag from (select *, row_number() over (partition by image_id, number order by dist, star_id) as k from n) n
 join fx_det d using (image_id, number) join fx_stars s on s.star_id=n.star_id where k=1)"""
R = 2.003


def pairs(spark, d):
    return match.make_pairs(view(spark, d, "fx_det", BY_STAR), view(spark, d, "fx_stars"), view(spark, d, "fx_images"), R)


@query("d01_match_radius", "with " + _NEAR.format(r="20.003") + " select image_id, number, star_id, round(dist,6) as dist, row_number() over (partition by image_id, number order by dist, star_id) as rank from n")
def d01(spark, d):
    near = match.neighbours(view(spark, d, "fx_det", BY_STAR), view(spark, d, "fx_stars0"), 20.003)
    # Rounded as DuckDB does; F.round goes by way of decimals, which costs more than all the rest.
    return near.select("image_id", "number", "star_id", (F.floor(F.col("dist") * 1e6 + 0.5) / 1e6).alias("dist"), "rank")


@query("d02_make_pairs", "with " + _PAIRS + " select image_id, number, star_id, round(dist,6) as dist, round(cat_mag,6) as cat_mag, round(sqrt(magerr_auto*magerr_auto+0.0004),6) as dy, round((x_image-1000)/1024,12) as coord_x, round((y_image-1000)/1024,12) as coord_y from p")
def d02(spark, d):
    return pairs(spark, d).select("image_id", "number", "star_id", *[F.round(c, n).alias(c) for c, n in (("dist", 6), ("cat_mag", 6), ("dy", 6), ("coord_x", 12), ("coord_y", 12))])


_RADIUS = "o as (select d.*, 3.0*sqrt(i.astsigma*i.astsigma+i.astvar*(d.errx2_image+d.erry2_image)) as obj_radius from fx_det d join fx_images i using (image_id))"


@query("d03_object_radius", f"with {_RADIUS} select image_id, number, round(obj_radius,6) as obj_radius from o")
def d03(spark, d):
    return match.object_radius(view(spark, d, "fx_det"), view(spark, d, "fx_images")).select("image_id", "number", F.round("obj_radius", 6).alias("obj_radius"))


@query("d03_image_radius", f"with {_RADIUS} select image_id, round(least(greatest(quantile_cont(obj_radius,0.95),0.5),10.0),6) as idlimit from (select *, row_number() over (partition by image_id order by number) as k from o) where k<=200 group by image_id")
def d03_image(spark, d):
    return match.image_radius(view(spark, d, "fx_det"), view(spark, d, "fx_images")).select("image_id", F.round("idlimit", 6).alias("idlimit"))


@query("d03_filter_by_object_radius", f"with {_RADIUS}, n as (select o.image_id, o.number, s.star_id from o join fx_stars0 s on abs(o.x_image-s.cat_x)<=2.003 and abs(o.y_image-s.cat_y)<=2.003 where sqrt(power(o.x_image-s.cat_x,2)+power(o.y_image-s.cat_y,2))<=least(2.003,o.obj_radius)) select * from n")
def d03_filter(spark, d):
    det = match.object_radius(view(spark, d, "fx_det"), view(spark, d, "fx_images"))
    near = match.range_join(det, view(spark, d, "fx_stars0"), R, ("x_image", "y_image"), ("cat_x", "cat_y"))
    return match.filter_by_object_radius(near).select("image_id", "number", "star_id")


@query("d04_unmatched", "with " + _NEAR.format(r="2.003") + " select image_id, number from fx_det where (image_id, number) not in (select (image_id, number) from n)")
def d04(spark, d):
    return match.unmatched(view(spark, d, "fx_det"), pairs(spark, d)).select("image_id", "number")


@query("d05_veto_phases", "with " + _NEAR.format(r="2.003") + """, u as (select * from fx_det where (image_id, number) not in (select (image_id, number) from n)),
 v as (select u.image_id, u.number, c.r1, sqrt(power(u.x_image-c.x,2)+power(u.y_image-c.y,2)) as dist from u join fx_cat2 c on abs(u.x_image-c.x)<=30.01 and abs(u.y_image-c.y)<=30.01)
 select u.image_id, u.number, case min(case when dist<=9.003 and r1<18 then 0 when dist<=12.004 and r1<17 then 1 when dist<=30.01 and r1<13 then 2 end) when 0 then 'simple' when 1 then 'double' when 2 then 'bright' end as killed_by
 from u left join v using (image_id, number) group by 1,2""")  # fmt: skip
def d05(spark, d):
    cand = match.unmatched(view(spark, d, "fx_det"), pairs(spark, d))
    phases = (("simple", 0.0, 9.003), ("double", 1.0, 12.004), ("bright", 5.0, 30.01))
    return match.veto_phases(cand, view(spark, d, "fx_cat2"), 18.0, phases).select("image_id", "number", "killed_by")


@query("d06_attach_images", "select image_id, number, jd, filter from fx_det join fx_images using (image_id)")
def d06(spark, d):
    return view(spark, d, "fx_det").join(view(spark, d, "fx_images"), "image_id").select("image_id", "number", "jd", "filter")


_SKY = "k as (select a.star_id as k1, b.star_id as k2 from fx_stars a join fx_stars b on a.star_id<b.star_id and abs(a.decdeg-b.decdeg)<0.0101 where 2*degrees(asin(sqrt(power(sin(radians(b.decdeg-a.decdeg)/2),2)+cos(radians(a.decdeg))*cos(radians(b.decdeg))*power(sin(radians(b.radeg-a.radeg)/2),2))))<0.01)"


@query("d07_dedupe_last", f"with {_SKY} select star_id from fx_stars where star_id not in (select k1 from k)")
def d07(spark, d):
    return match.dedupe_sky(view(spark, d, "fx_stars"), 0.01, "last", "star_id", ("radeg", "decdeg")).select("star_id")


@query("d07_dedupe_first", f"""with recursive {_SKY}, o as (select star_id, row_number() over (order by star_id) as i from fx_stars), m as (select max(i) as m from o),
 g as (select 0::bigint as i, []::bigint[] as kept union all select g.i+1, case when exists (select 1 from k where k.k2=o.star_id and list_contains(g.kept, k.k1)) then g.kept else list_append(g.kept, o.star_id) end from g join o on o.i=g.i+1)
 select unnest(kept) as star_id from g, m where g.i=m.m""")  # fmt: skip
def d07_first(spark, d):
    return match.dedupe_sky(view(spark, d, "fx_stars"), 0.01, "first", "star_id", ("radeg", "decdeg")).select("star_id")


@query("d08_find_target", "select image_id, number, round(target_dist,6) as target_dist from (select image_id, number, sqrt(power(x_image-1010.003,2)+power(y_image-990.003,2)) as target_dist, row_number() over (partition by image_id order by sqrt(power(x_image-1010.003,2)+power(y_image-990.003,2)), number) as k from fx_det where image_id%5<>4) where k=1 and target_dist<=60.0")
def d08(spark, d):
    targets = sql(spark, d, "select image_id, case when image_id%5=4 then -100.0e0 else 150.0e0 end as objra, 20.0e0 as objdec, 1010.003e0 as target_x, 990.003e0 as target_y from fx_images")
    return match.find_target(view(spark, d, "fx_det"), targets, 60.0).select("image_id", "number", F.round("target_dist", 6).alias("target_dist"))


_SKYDET = "select d.image_id, d.number, d.mag_auto+22 as mag_calib, d.magerr_auto as magerr_calib, s.radeg as alpha_j2000, s.decdeg as delta_j2000 from fx_det d join fx_stars s on s.star_id=d.true_star_id"


@query("d09_extract_target", f"""with s as ({_SKYDET}), t as (select * from (values (1,150.03,20.05),(2,149.9,19.95)) v(target_id, ra, dec)),
 m as (select image_id, target_id, number, mag_calib, 3600*sqrt(power((alpha_j2000-ra)*cos(radians(dec)),2)+power(delta_j2000-dec,2)) as sep from s, t),
 b as (select *, row_number() over (partition by image_id, target_id order by sep, number) as k from m where sep<=60.0)
 select i.image_id, t.target_id::bigint as target_id, b.number, round(b.sep,5) as sep, round(b.mag_calib,6) as mag_calib, case when b.number is null then 'not_found' else 'ok' end as status from fx_images i cross join t left join b on b.image_id=i.image_id and b.target_id=t.target_id and k=1""")  # fmt: skip
def d09(spark, d):
    found = match.extract_target(sql(spark, d, _SKYDET), view(spark, d, "fx_images"), [(1, 150.03, 20.05), (2, 149.9, 19.95)], 60.0)
    return found.select("image_id", "target_id", "number", F.round("sep", 5).alias("sep"), F.round("mag_calib", 6).alias("mag_calib"), "status")


@query("d10_merge_photometry", "select image_id, number, round(mag_auto+0.1,6) as mag_auto, 0.05 as magerr_auto from fx_det where flags=0")
def d10(spark, d):
    phot = sql(spark, d, "select image_id, number as id, mag_auto+0.1 as mag, 0.05e0 as merr from fx_det where flags=0")
    return match.merge_photometry(view(spark, d, "fx_det"), phot).select("image_id", "number", F.round("mag_auto", 6).alias("mag_auto"), "magerr_auto")


@query("d11_inject_target", "select image_id, number, false as is_target from fx_det union all select image_id, 0, true from fx_images i where not exists (select 1 from fx_det d where d.image_id=i.image_id and sqrt(power(x_image-1010.003,2)+power(y_image-990.003,2))<=fwhm*10)")
def d11(spark, d):
    targets = sql(spark, d, "select image_id, 150.0e0 as objra, 20.0e0 as objdec, 1010.003e0 as target_x, 990.003e0 as target_y, fwhm*10 as fwhm from fx_images")
    return match.inject_target(view(spark, d, "fx_det"), targets).select("image_id", "number", "is_target")


@query("d12_splice_target", """with t as (select *, sqrt(power(x_image-1010.003,2)+power(y_image-990.003,2)) as r from fx_det), f as (select image_id, number, x_image+1 as x_image, y_image, sqrt(power(x_image+1-1010.003,2)+power(y_image-990.003,2)) as r from fx_det where image_id%2=0),
 c as (select *, row_number() over (partition by image_id order by case when number=0 then 0 else 1 end, r, number) as k from f where r<=100.0)
 select image_id, number, round(x_image,4) as x_image from t where not (r<=100.0 and image_id in (select image_id from c)) union all select image_id, number, round(x_image,4) from c where k=1""")  # fmt: skip
def d12(spark, d):
    targets = sql(spark, d, "select image_id, 1010.003e0 as target_x, 990.003e0 as target_y from fx_images")
    diff = view(spark, d, "fx_det").where("image_id%2=0").withColumn("x_image", F.col("x_image") + 1)
    return match.splice_target(view(spark, d, "fx_det"), diff, targets, 100.0).select("image_id", "number", F.round("x_image", 4).alias("x_image"))


@query("d13_attach_results", "select image_id, 15.0+image_id%7 as phot_mag from fx_images where image_id%3<>0")
def d13(spark, d):
    images = view(spark, d, "fx_images").withColumn("fitsfile", F.concat(F.lit("/a/b/"), "image_id", F.lit(".fits")))
    results = view(spark, d, "fx_images").where("image_id%3<>0").select(F.concat(F.lit("x/"), "image_id", F.lit(".fits")).alias("file"), (15.0 + F.col("image_id") % 7).alias("mag"), F.lit(0.1).alias("magerr"))
    return match.attach_results(images, results).select("image_id", "phot_mag")


@query("d14_dynamic_maglim", "with " + _PAIRS + ", z as (select image_id, median(cat_mag-mag_auto) as z from p group by 1) select image_id, round(greatest(-5.0+coalesce(z,0)-2.0, 14.003),6) as maglim from fx_images left join z using (image_id)")
def d14(spark, d):
    images = view(spark, d, "fx_images").withColumns({"limflx3": F.lit(-5.0), "first": F.lit(14.003)})
    zero = calib.zeropoints(pairs(spark, d), images)
    return match.dynamic_maglim(images, zero, 2.0, first="first").select("image_id", F.round("maglim", 6).alias("maglim"))


@query("d14_match_to_limit", "with " + _NEAR.format(r="2.003") + " select n.image_id, n.number, n.star_id from n join fx_stars s using (star_id) where s.sloan_r<=20.003+n.image_id%7*5")
def d14_match(spark, d):
    images = view(spark, d, "fx_images").select("image_id", (20.003 + F.col("image_id") % 7 * 5).alias("maglim"))
    return match.match_to_limit(view(spark, d, "fx_det"), view(spark, d, "fx_stars"), images, R).select("image_id", "number", "star_id")


@query("e09_radius_percentiles", f"with {_RADIUS} select image_id, round(quantile_cont(obj_radius,0.95),6) as r95, round(quantile_cont(obj_radius,0.5),6) as r50, round(quantile_cont(obj_radius,0.2),6) as r20 from (select *, row_number() over (partition by image_id order by number) as k from o) where k<=100 group by 1")
def e09(spark, d):
    return match.radius_percentiles(view(spark, d, "fx_det"), view(spark, d, "fx_images")).select("image_id", *[F.round(c, 6).alias(c) for c in ("r95", "r50", "r20")])


@query("flagship_calibration", "with " + _PAIRS + ", z as (select image_id, median(cat_mag-mag_auto) as z from p group by 1) select p.image_id, count(*) as n_pairs, round(any_value(z),6) as zeropoint, round(median(abs(cat_mag-mag_auto-z))/0.67,6) as sigma from p join z using (image_id) group by 1")
def flagship(spark, d):
    out = pipelines.calibrate_images(view(spark, d, "fx_det"), view(spark, d, "fx_stars"), view(spark, d, "fx_images"), R)
    return out["scatter"].select("image_id", "n_pairs", F.round("zeropoint", 6).alias("zeropoint"), F.round("sigma", 6).alias("sigma"))


@query("b27_calibrate", "with " + _PAIRS + ", z as (select image_id, median(cat_mag-mag_auto) as z from p group by 1) select d.image_id, number, round(mag_auto+coalesce(z,0),3) as mag_calib, round(magerr_auto,6) as magerr_calib from fx_det d left join z using (image_id)")
def b27(spark, d):
    out = pipelines.calibrate_images(view(spark, d, "fx_det"), view(spark, d, "fx_stars"), view(spark, d, "fx_images"), R)
    return out["calibrated"].select("image_id", "number", F.round("mag_calib", 3).alias("mag_calib"), F.round("magerr_calib", 6).alias("magerr_calib"))


@query("d_sky_join_wrap", """with s as (select star_id, (radeg+210.0)%360.0 as ra, decdeg from fx_stars) select a.star_id as k1, b.star_id as k2 from s a join s b on a.star_id<b.star_id and abs(a.decdeg-b.decdeg)<0.011
 where 2*degrees(asin(sqrt(power(sin(radians(b.decdeg-a.decdeg)/2),2)+cos(radians(a.decdeg))*cos(radians(b.decdeg))*power(sin(radians(b.ra-a.ra)/2),2))))<0.01""")  # fmt: skip
def sky_wrap(spark, d):
    """The field lies across RA 0."""
    stars = view(spark, d, "fx_stars").select("star_id", F.pmod(F.col("radeg") + 210, F.lit(360.0)).alias("radeg"), "decdeg")
    return match.close_pairs(stars, 0.01, "star_id", ("radeg", "decdeg"), ())



"""Stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import sql, view
from ..operators import stack
from ..plans import pipelines
from . import query

_W = """c as (select *, 2.3*power(10,-0.4*(15.0-magzero)) as counts from fx_images), s as (select *, power(counts/(select sum(counts) from c),2)/(counts+pi()*power(fwhm/2,2)*power(2.3*bgsigma,2)) as w0 from c),
 w as (select image_id, jd, exptime, filter, field_id, coalesce(w0,0)*(select count(*) from s where w0>0)/(select sum(w0) from s) as weight from s)"""


def _weights(spark, d):
    return stack.stack_weights(view(spark, d, "fx_images"), 2.3)


@query("e26_stack_weights", f"with {_W} select image_id, round(weight,9) as weight from w")
def e26(spark, d):
    return _weights(spark, d).select("image_id", F.round("weight", 9).alias("weight"))


@query("e26_stack_weights_uniform", "select image_id, (select count(*) from fx_images)::double as weight from fx_images")
def e26_uniform(spark, d):
    return stack.stack_weights(view(spark, d, "fx_images"), 2.3, uniform=True).select("image_id", "weight")


@query("e27_stack_metadata", f"""with {_W}, u as (select *, 2.3+0.1*(image_id%3) as gain, 5.0+image_id%2 as rnoise from w where weight>0), k as (select 'filter' as key, filter as value, count(*) as c, min(jd) as o from u group by filter union all select 'field_id', cast(field_id as varchar), count(*), min(jd) from u group by field_id)
 select key, case when key='filter' then value end as text, case when key<>'filter' then value::double end as number from (select *, row_number() over (partition by key order by c desc, o) as r from k) where r=1
 union all select v.key, null, round(v.number,6) from (select count(*)::double as n, min(jd) as a, max(jd+exptime/86400) as b, sum(exptime) as e, sum(weight*gain)/sum(weight) as g, sqrt(sum(power(weight*rnoise,2))) as r from u) q, lateral (values ('NCOMBINE', n), ('DATE_OPEN', a), ('DATE_CLOSE', b), ('EXPTIME', e), ('GAIN', g), ('RNOISE', r)) v(key, number)""")  # fmt: skip
def e27(spark, d):
    images = _weights(spark, d).withColumns({"gain": 2.3 + 0.1 * (F.col("image_id") % 3), "rnoise": 5.0 + F.col("image_id") % 2})
    text = F.when(F.col("key") == "filter", F.col("value")).alias("text")
    return stack.stack_metadata(images, ["filter", "field_id"]).select("key", text, F.round(F.col("value").try_cast("double"), 6).alias("number"))


@query("e28_chartime", f"with {_W} select round(sum(jd*weight)/sum(weight),6) as chartime from w")
def e28(spark, d):
    return stack.chartime(_weights(spark, d)).select(F.round("chartime", 6).alias("chartime"))


@query("e28_chartime_powerlaw", f"""with {_W}, t as (select jd-2460309.5 as t, exptime/86400/2 as h, weight as w from w), q as (select power(t+h,0.8)-power(t-h,0.8) as a, power(t+h,-0.2)-power(t-h,-0.2) as b, w from t where t>h)
 select round((1-1.2)/(2-1.2)*sum(a*b*b*w)/sum(b*b*b*w)+2460309.5,5) as chartime from q""")  # fmt: skip
def e28_power(spark, d):
    return stack.chartime(_weights(spark, d), 2460309.5, 1.2).select(F.round("chartime", 5).alias("chartime"))


@query("e29_coadd", f"with {_W}, m as (select image_id, max(weight) as top from fx_pixels group by 1) select y, x, round(sum(w.weight*p.weight/top*value)/sum(w.weight*p.weight/top),6) as value, round(sum(w.weight*p.weight/top),6) as weight, count(*) as n from fx_pixels p join w using (image_id) join m using (image_id) where w.weight>0 group by 1,2")
def e29(spark, d):
    out = stack.coadd(view(spark, d, "fx_pixels"), _weights(spark, d))
    return out.select("y", "x", F.round("value", 6).alias("value"), F.round("weight", 6).alias("weight"), "n")


@query("e30_flat_correct", "with f as (select image_id, y, x, case when (x+y)%9=0 then 0 else 1.0+0.01*(x%7) end as f from fx_pixels where image_id%2=0), m as (select image_id, median(case when f<>0 then f end) as m from f group by 1) select p.image_id, p.y, p.x, round(case when f.f is null or f.f=0 then value else value/(f.f/m.m) end,6) as value from fx_pixels p left join f using (image_id, y, x) left join m using (image_id)")
def e30(spark, d):
    flats = sql(spark, d, "select image_id, y, x, case when (x+y)%9=0 then 0.0e0 else 1.0e0+0.01e0*(x%7) end as flat from fx_pixels where image_id%2=0")
    return stack.flat_correct(view(spark, d, "fx_pixels"), flats).select("image_id", "y", "x", F.round("value", 6).alias("value"))


FRAME = {"crval1": 150.0, "crval2": 20.0, "scale": 0.0123, "size_x": 80, "size_y": 80, "crpix1": 40.0, "crpix2": 40.0}
_GEOM = "select *, 0.0003e0 as pixel_scale, 0.0003e0*sqrt(imgaxis1*imgaxis1+imgaxis2*imgaxis2) as diagonal, ctrra as crval1, ctrdec as crval2, 1000.0e0 as crpix1, 1000.0e0 as crpix2, -0.0003e0 as cd1_1, 0.0e0 as cd1_2, 0.0e0 as cd2_1, 0.0003e0 as cd2_2 from fx_images"


_COVERAGE = """g as (select x, y, radians((x-40.0)*0.0123) as u, radians((y-40.0)*0.0123) as v from (select unnest(range(0,80)) as x), (select unnest(range(0,80)) as y)),
 s as (select x, y, radians(150.0)+atan2(u, cos(radians(20.0))-v*sin(radians(20.0))) as a, asin((sin(radians(20.0))+v*cos(radians(20.0)))/sqrt(1+u*u+v*v)) as d from g),
 n as (select x, y, sin(d)*sin(radians(ctrdec))+cos(d)*cos(radians(ctrdec))*cos(a-radians(ctrra)) as c, cos(d)*sin(a-radians(ctrra)) as p, sin(d)*cos(radians(ctrdec))-cos(d)*sin(radians(ctrdec))*cos(a-radians(ctrra)) as q, imgaxis1, imgaxis2 from s cross join fx_images),
 cov as materialized (select y, x, count(*) as n from n where c>0 and 1000.0-degrees(p/c)/0.0003 between 0 and imgaxis1 and 1000.0+degrees(q/c)/0.0003 between 0 and imgaxis2 group by 1,2)"""


@query("e31_coverage", f"with {_COVERAGE} select y, x, n from cov")
def e31(spark, d):
    return stack.coverage(sql(spark, d, _GEOM), FRAME)


@query("e32_reference_frame", """with i as (select ctrra, ctrdec, 0.0003e0*(1+0.1*(image_id%3)) as s, 0.85e0+0.01*(image_id%5) as g from fx_images), a as (select avg(ctrra) as crval1, avg(ctrdec) as crval2, max(s)*8 as scale, median(s)*8 as m, median(g) as g, max(ctrra)-min(ctrra) as dr, max(ctrdec)-min(ctrdec) as dd, (max(ctrdec)+min(ctrdec))/2 as md from i)
 select round(crval1,8) as crval1, round(crval2,8) as crval2, round(scale,8) as scale, greatest(floor((g+dr*cos(radians(md)))/m),64)::bigint as size_x, greatest(floor((g+dd)/m),64)::bigint as size_y from a""")  # fmt: skip
def e32(spark, d):
    images = sql(spark, d, "select ctrra, ctrdec, 0.0003e0*(1+0.1e0*(image_id%3)) as pixel_scale, 0.85e0+0.01e0*(image_id%5) as diagonal from fx_images")
    return stack.reference_frame(images).select(*[F.round(c, 8).alias(c) for c in ("crval1", "crval2", "scale")], "size_x", "size_y")


_BOX = f"""{_COVERAGE}, f as (select y, x from cov where n=(select max(n) from cov)), b as (select distinct y as y1 from f), r as (select x, y1, y2 from (select distinct x from f), (select b1.y1, b2.y1 as y2 from b b1 join b b2 on b1.y1<=b2.y1)),
 k as (select r.x, y1, y2 from r join f on f.x=r.x and f.y between y1 and y2 group by 1,2,3 having count(*)=y2-y1+1), o as (select *, x-row_number() over (partition by y1, y2 order by x) as g from k),
 w as (select y1 as y, min(x) as x, count(*) as w, y2-y1+1 as h, y2 from o group by y1, y2, g), m as (select * from w order by w*h desc, y2, x, h desc limit 1)"""


def _frame_sql(factor: int) -> str:
    return f"with {_BOX} select x, y, w, h, w*h as area, 150.0 as crval1, 20.0 as crval2, round(0.0123/{factor},9) as scale, round((40.0-x)*{factor},6) as crpix1, round((40.0-y)*{factor},6) as crpix2, w*{factor} as size_x, h*{factor} as size_y from m"


def _frame(spark, d, zoom):
    box = stack.largest_rectangle(stack.coverage(sql(spark, d, _GEOM), FRAME), "in")
    return stack.cropped_frame(box, FRAME, zoom=zoom).withColumns({"scale": F.round("scale", 9), "crpix1": F.round("crpix1", 6), "crpix2": F.round("crpix2", 6)})


@query("e33_largest_rectangle", _frame_sql(8))
def e33(spark, d):
    """E33 on E31's coverage by all images: the rectangle and the frame cropped to it."""
    return _frame(spark, d, 1.0)


@query("e33_zoomed_frame", _frame_sql(12))
def e33_zoomed(spark, d):
    """The same with half as many pixels again."""
    return _frame(spark, d, 1.5)


@query("e34_cluster_images", """with p as (select a.image_id, min(sqrt(power((a.ctrra-b.ctrra)*cos(radians(case when a.image_id<b.image_id then a.ctrdec else b.ctrdec end)),2)+power(a.ctrdec-b.ctrdec,2))) as nn from fx_images a join fx_images b on a.image_id<>b.image_id group by 1),
 m as (select median(field) as m from fx_images), g as (select nn, lead(nn) over (order by nn)-nn as g from p), t as (select coalesce(min(nn),(select 2*m from m)) as t from g, m where g.g>m/10)
 select image_id, round(nn,6) as nn, nn<t as valid from p, t""")  # fmt: skip
def e34(spark, d):
    return stack.cluster_images(view(spark, d, "fx_images")).select("image_id", F.round("nn", 6).alias("nn"), "valid")


@query("e35_bright_catalog", """with recursive k as (select a.star_id as k1, b.star_id as k2 from fx_stars a join fx_stars b on a.star_id<b.star_id and abs(a.decdeg-b.decdeg)<0.0101 and a.sloan_r<60.003 and b.sloan_r<60.003 where 2*degrees(asin(sqrt(power(sin(radians(b.decdeg-a.decdeg)/2),2)+cos(radians(a.decdeg))*cos(radians(b.decdeg))*power(sin(radians(b.radeg-a.radeg)/2),2))))<0.01),
 o as (select star_id, row_number() over (order by star_id) as i from fx_stars where sloan_r<60.003), m as (select max(i) as m from o),
 g as (select 0::bigint as i, []::bigint[] as kept union all select g.i+1, case when exists (select 1 from k where k.k2=o.star_id and list_contains(g.kept, k.k1)) then g.kept else list_append(g.kept, o.star_id) end from g join o on o.i=g.i+1)
 select star_id, round(sloan_r,6) as g from fx_stars where star_id in (select unnest(kept) from g, m where g.i=m.m)""")  # fmt: skip
def e35(spark, d):
    from ..operators.catalog import bright_catalog

    stars = sql(spark, d, "select star_id, radeg, decdeg, sloan_r as g, sloan_g as bp, sloan_i as rp, 1.0e0 as ruwe, 9 as visibility_periods_used, 1 as g_snr, 1 as bp_snr, 1 as rp_snr from fx_stars")
    return bright_catalog(stars, 60.003, 0.01).select("star_id", F.round("g", 6).alias("g"))


@query("stack_images", """with p as (select a.image_id, min(sqrt(power((a.ctrra-b.ctrra)*cos(radians(case when a.image_id<b.image_id then a.ctrdec else b.ctrdec end)),2)+power(a.ctrdec-b.ctrdec,2))) as nn from fx_images a join fx_images b on a.image_id<>b.image_id group by 1),
 m as (select median(field) as m from fx_images), h as (select nn, lead(nn) over (order by nn)-nn as g from p), t as (select coalesce(min(nn),(select 2*m from m)) as t from h, m where h.g>m/10), v as (select image_id from p, t where nn<t),
 f as (select image_id, y, x, value, abs(value-lead(value) over (partition by image_id, x order by y)) as d from fx_pixels), l as (select image_id, y, median(d) as d from f group by 1,2), n as (select image_id, 1.0489*median(d) as bg from l group by 1),
 c as (select i.image_id, fwhm, bg, 2.3*power(10,-0.4*(15.0-magzero)) as counts from fx_images i join v using (image_id) join n using (image_id)),
 s as (select *, power(counts/(select sum(counts) from c),2)/(counts+pi()*power(fwhm/2,2)*power(2.3*bg,2)) as w0 from c), w as (select image_id, coalesce(w0,0)*(select count(*) from s where w0>0)/(select sum(w0) from s) as weight from s),
 o as (select image_id, max(weight) as top from fx_pixels group by 1)
 select y, x, round(sum(w.weight*q.weight/top*value)/sum(w.weight*q.weight/top),6) as value, round(sum(w.weight*q.weight/top),6) as weight, count(*) as n from fx_pixels q join w using (image_id) join o using (image_id) where w.weight>0 group by 1,2""")  # fmt: skip
def stack_images(spark, d):
    out = pipelines.stack_images(view(spark, d, "fx_pixels"), view(spark, d, "fx_images"))["coadd"]
    return out.select("y", "x", F.round("value", 6).alias("value"), F.round("weight", 6).alias("weight"), "n")

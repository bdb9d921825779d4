"""E: statistics per image; F04, F05 and window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import sql, view
from ..operators import calib
from . import query
from .matching import _PAIRS, pairs


def _round(df, keep, **columns):
    return df.select(*keep, *[F.round(c, n).alias(c) for c, n in columns.items()])


@query("e01_zeropoints", "with " + _PAIRS + " select image_id, round(coalesce(median(cat_mag-mag_auto),0),6) as zeropoint, count(p.number) as n from fx_images left join p using (image_id) group by 1")
def e01(spark, d):
    return _round(calib.zeropoints(pairs(spark, d), view(spark, d, "fx_images")), ["image_id", "n"], zeropoint=6)


@query("e02_rough_zeropoint", "with " + _PAIRS + ", q as (select image_id, quantile_cont(mag_auto,0.3) as q from p group by 1), z as (select image_id, median(cat_mag-mag_auto) as z from p join q using (image_id) where mag_auto<q group by 1) select image_id, round(coalesce(z,0),6) as zeropoint from fx_images left join z using (image_id)")
def e02(spark, d):
    return _round(calib.rough_zeropoint(pairs(spark, d), view(spark, d, "fx_images")), ["image_id"], zeropoint=6)


FILTERS = ["sloan_g", "sloan_r", "sloan_i", "sloan_z"]
_ALL = "with " + _PAIRS + """, l as (select image_id, mag_auto, 'sloan_g' as filter, sloan_g as m from p union all select image_id, mag_auto, 'sloan_r', sloan_r from p union all select image_id, mag_auto, 'sloan_i', sloan_i from p union all select image_id, mag_auto, 'sloan_z', sloan_z from p),
 z as (select image_id, filter, median(m-mag_auto) as z, count(*) as n from l group by 1,2), o as (select l.*, z.z, n, abs(m-mag_auto-z.z) as off from l join z using (image_id, filter)), a as (select image_id, filter, median(off) as mad from o group by 1,2),
 g as (select image_id, filter, corr(m,mag_auto) as c, count(*) as k from o join a using (image_id, filter) where off<3*mad group by 1,2),
 r as (select z.image_id, z.filter, z.z as zeropoint, n, case when n>=5 and k>=5 and not isnan(c) then coalesce(c,0) else 0 end as correlation from z left join g using (image_id, filter))"""


@query("e03_zeropoints_all", _ALL + " select image_id, filter, round(zeropoint,6) as zeropoint, n, round(correlation,6) as correlation from r")
def e03(spark, d):
    return _round(calib.zeropoints_all(pairs(spark, d), FILTERS), ["image_id", "filter", "n"], zeropoint=6, correlation=6)


@query("e03_filter_scores", _ALL + " select filter, round(coalesce(avg(case when correlation>0 then correlation end),0),6) as score, count(case when correlation>0 then 1 end) as n_images, sum(n)::bigint as total_stars from r group by 1")
def e03_scores(spark, d):
    return _round(calib.filter_scores(calib.zeropoints_all(pairs(spark, d), FILTERS)), ["filter", "n_images", "total_stars"], score=6)


@query("e04_decide_filter", _ALL + ", s as (select filter, coalesce(avg(case when correlation>0 then correlation end),0) as score from r group by 1) select image_id, (select filter from s order by score desc, filter limit 1) as filter from fx_images")
def e04(spark, d):
    scores = calib.filter_scores(calib.zeropoints_all(pairs(spark, d), FILTERS))
    return view(spark, d, "fx_images").select("image_id", F.lit(calib.decide_filter(scores, "sloan_g", "discover")).alias("filter"))


@query("e05_filter_consistency", "select filter, count(*) as n, (select count(distinct filter) from fx_images) as n_filters, (select count(distinct filter) from fx_images)>1 as mixed from fx_images group by 1")
def e05(spark, d):
    return calib.filter_consistency(view(spark, d, "fx_images"))


#: Images of three kinds, for the three ways to choose rows: good errors, large errors, few rows inside.
_FWHM = "select image_id, number, mag_auto, fwhm_image, y_image, case when image_id%3=1 then 1.0e0 else magerr_auto end as magerr_auto, case when image_id%3=2 and number%50>0 then 5.0e0 else x_image end as x_image from fx_det"


@query("e06_image_fwhm", f"""with r as (select d.*, x_image>32 and y_image>32 and x_image<imgaxis1-32 and y_image<imgaxis2-32 as i from ({_FWHM}) d join fx_images using (image_id)),
 q as (select *, row_number() over (partition by image_id, i order by mag_auto, number) as k from r)
 select image_id, round(coalesce(case when count(case when i and magerr_auto<1.091/10 then 1 end)>=30 then median(case when i and magerr_auto<1.091/10 then fwhm_image end) end, case when count(case when i then 1 end)>=30 then median(case when i and k<=30 then fwhm_image end) end, median(fwhm_image)),6) as image_fwhm from q group by 1""")  # fmt: skip
def e06(spark, d):
    return _round(calib.image_fwhm(sql(spark, d, _FWHM), view(spark, d, "fx_images")), ["image_id"], image_fwhm=6)


@query("e07_background_stats", """with f as (select image_id, y, x, value, abs(value-lead(value) over (partition by image_id, x order by y)) as d from fx_pixels), r as (select image_id, y, median(d) as d from f group by 1,2)
 select r.image_id, round(1.0489*median(r.d),6) as bgsigma, round(any_value(m.m),6) as bgmedian from r join (select image_id, median(value) as m from fx_pixels group by 1) m using (image_id) group by 1""")  # fmt: skip
def e07(spark, d):
    return _round(calib.background_stats(view(spark, d, "fx_pixels")), ["image_id"], bgsigma=6, bgmedian=6)


#: The error grows with the magnitude here, so that the fit has something to find.
_LIMIT = "select image_id, number, mag_auto, power(10.0e0, (mag_auto-30.0e0)/25)*0.05e0+magerr_auto*0.1e0 as magerr_auto from fx_det"
_LINE = "(sum(w*x*t)-sum(w*x)*sum(w*t)/sum(w))/(sum(w*x*x)-sum(w*x)*sum(w*x)/sum(w))"


@query("e08_limiting_mag", f"""with recursive r as (select image_id, mag_auto as x, log10(magerr_auto*ln(2.5)*3) as t from ({_LIMIT}) where magerr_auto>=0.001),
 f as (select image_id, 1 as k, {_LINE} as a, sum(w*t)/sum(w)-{_LINE}*sum(w*x)/sum(w) as b from (select *, 1.0 as w from r) group by image_id
 union all select image_id, any_value(k)+1, {_LINE}, sum(w*t)/sum(w)-{_LINE}*sum(w*x)/sum(w) from (select f.image_id, k, x, t, 1/(1+power(t-a*x-b,2)) as w from f join r using (image_id) where k<25) group by image_id)
 select image_id, round(-b/a,4) as limflx3, round(-b/a+log10(1.091/10)/a,4) as limflx10 from f where k=25""")  # fmt: skip
def e08(spark, d):
    return _round(calib.limiting_mag(sql(spark, d, _LIMIT)), ["image_id"], limflx3=4, limflx10=4)


@query("e10_robust_sigma", "select image_id, round(median(abs(mag_auto))/0.67,6) as sigma from fx_det group by 1")
def e10(spark, d):
    return view(spark, d, "fx_det").groupBy("image_id").agg(F.round(calib.robust_sigma(F.col("mag_auto")), 6).alias("sigma"))


@query("e11_astrometric_error_model", "with " + _PAIRS + """, q as (select image_id, dist, dist*dist as r2, errx2_image+erry2_image as c2, count(*) over (partition by image_id) as n, row_number() over (partition by image_id order by errx2_image+erry2_image, number)-1 as i from p),
 k as (select *, greatest(least(10, n//5),1) as k from q), b as (select *, case when i<(n%k)*(n//k+1) then i//(n//k+1) else n%k+(i-(n%k)*(n//k+1))//(n//k) end as b from k),
 m as (select image_id, b, median(r2) as r, median(c2) as c from b group by 1,2), s as (select x.image_id, median(case when abs(y.c-x.c)>1e-12 then (y.r-x.r)/(y.c-x.c) end) as sc from m x join m y on x.image_id=y.image_id and x.b<y.b group by 1),
 f as (select m.image_id, greatest(coalesce(any_value(sc),0),0) as sc, greatest(median(r-greatest(coalesce(sc,0),0)*c),0) as s0 from m left join s using (image_id) group by 1),
 e as (select image_id, max(n) as n, median(r2) as mid, median(abs(dist))/0.67 as scatter from q group by 1)
 select image_id, round(sqrt(case when n<10 then mid else s0 end),6) as astsigma, round(case when n<10 then 1.0 else sc end,6) as astvar, round(scatter,6) as scatter from e join f using (image_id)""")  # fmt: skip
def e11(spark, d):
    return _round(calib.astrometric_error_model(pairs(spark, d)), ["image_id"], astsigma=6, astvar=6, scatter=6)


@query("e12_variance_model", "with " + _PAIRS + """, r as (select image_id, number, dist*dist as t, errx2_image+erry2_image as c, sqrt(power((x_image-1000)/1024,2)+power((y_image-1000)/1024,2)) as r from p),
 i as (select *, count(*) over w as n, row_number() over (partition by image_id order by c, number)-1 as i, quantile_cont(c, 0.5) over w as c0 from r window w as (partition by image_id)),
 b as (select image_id, i//greatest(10, n//19) as b, median(t) as t, power(median(c)-any_value(c0),2) as x, median(r) as y, any_value(c0) as c0, count(*) as w from i group by 1, 2),
 m as (select image_id, sum(w*x)/sum(w) as mx, sum(w*y)/sum(w) as my, sum(w*t)/sum(w) as mt from b group by 1),
 s as (select image_id, any_value(mx) as mx, any_value(my) as my, any_value(mt) as mt, any_value(c0) as c0, sum(w*(x-mx)*(x-mx)) as xx, sum(w*(x-mx)*(y-my)) as xy, sum(w*(y-my)*(y-my)) as yy, sum(w*(x-mx)*(t-mt)) as xt, sum(w*(y-my)*(t-mt)) as yt from b join m using (image_id) group by 1),
 f as (select *, (xt*yy-yt*xy)/(xx*yy-xy*xy) as sc0, (yt*xx-xt*xy)/(xx*yy-xy*xy) as sr0, (yt-25*xy)/yy as sr1 from s)
 select image_id, round(case when abs(sc0)>1000 then mt-25*mx-sr1*my else mt-sc0*mx-sr0*my end,4) as s0, round(case when abs(sc0)>1000 then 25.0 else sc0 end,3) as sc, round(case when abs(sc0)>1000 then sr1 else sr0 end,4) as sr, round(c0,6) as c0 from f""")  # fmt: skip
def e12(spark, d):
    return _round(calib.variance_model(pairs(spark, d)), ["image_id"], s0=4, sc=3, sr=4, c0=6)


@query("e12_predict_sigma", "with " + _PAIRS + " select image_id, number, round(sqrt(greatest(0.1+0.5*power(errx2_image+erry2_image-0.3,2)-0.05*sqrt(power((x_image-1000)/1024,2)+power((y_image-1000)/1024,2)),0)),6) as sigma from p")
def e12_predict(spark, d):
    model = sql(spark, d, "select image_id, 0.1e0 as s0, 0.5e0 as sc, -0.05e0 as sr, 0.3e0 as c0 from fx_images")
    return _round(calib.predict_sigma(pairs(spark, d), model), ["image_id", "number"], sigma=6)


@query("e24_class_summary", "select image_id, count(case when flags=1 then 1 end) as brighter, count(case when flags=0 and number%2=0 then 1 end) as normal, count(*) as total from fx_det group by 1")
def e24(spark, d):
    rows = view(spark, d, "fx_det").withColumn("type", F.when(F.col("flags") == 1, "brighter").when(F.col("number") % 2 == 0, "normal"))
    return calib.class_summary(rows).select("image_id", "brighter", "normal", "total")

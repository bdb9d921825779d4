"""K and F: transients."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..fixtures import sql, view
from ..operators import match, transients
from ..plans import pipelines
from . import query
from .matching import R, _NEAR

_DET = "select d.*, mag_auto+i.true_zp as mag_calib, magerr_auto as magerr_calib from fx_det d join fx_images i using (image_id)"


def _near(spark, d):
    return match.range_join(sql(spark, d, _DET), view(spark, d, "fx_stars"), R, ("x_image", "y_image"), ("cat_x", "cat_y"))


_BEST = "with " + _NEAR.format(r="2.003") + f""", t as ({_DET}), m as (select t.image_id, t.number, n.star_id, case i.filter when 'Sloan_g' then s.sloan_g else s.sloan_r end as mag, t.mag_calib, t.magerr_calib as e
  from n join t using (image_id, number) join fx_stars s on s.star_id=n.star_id join fx_images i on i.image_id=t.image_id),
 b as (select *, (mag-mag_calib)/sqrt(e*e+0.01*0.01) as p, row_number() over (partition by image_id, number order by abs((mag-mag_calib)/sqrt(e*e+0.01*0.01)), star_id) as k from m),
 c as (select t.image_id, t.number, t.magerr_calib as e, t.fwhm_image/i.fwhm as r, b.p, b.mag, abs(b.mag-t.mag_calib) as md, (b.mag-t.mag_calib)/t.magerr_calib as raw from t join fx_images i using (image_id) left join b on b.image_id=t.image_id and b.number=t.number and k=1)"""


@query("k01_classify", _BEST + """ select image_id, number, case when not e<1.091/20 then null when mag is null then case when r>1.5 or r<1/1.5 then 'poor_fwhm' else 'uncatalogued' end when p>20 and md>0.05 then 'brighter' when p<-20 and md>0.05 then 'fainter' when (p>-20 and raw<20) or md<0.05 then 'normal' end as type from c""")
def k01(spark, d):
    out = transients.classify(sql(spark, d, _DET), _near(spark, d), view(spark, d, "fx_images"), 20.0)
    return out.select("image_id", "number", "type")


@query("k02_band_for", "select image_id, case filter when 'Sloan_g' then 'sloan_g' else 'sloan_r' end as band from fx_images")
def k02(spark, d):
    return view(spark, d, "fx_images").select("image_id", transients.band_for(F.col("filter")).alias("band"))


@query("k03_comparison_error", "select image_id, number, round(sqrt(magerr_auto*magerr_auto+0.01*0.01),6) as e from fx_det")
def k03(spark, d):
    return view(spark, d, "fx_det").select("image_id", "number", F.round(transients.comparison_error(F.col("magerr_auto")), 6).alias("e"))


@query("k04_candidates", "with " + _NEAR.format(r="2.003") + """, u as (select * from fx_det where (image_id, number) not in (select (image_id, number) from n) and magerr_auto<1.091/60 and x_image>=32.003 and y_image>=32.003 and x_image<=2002-32.003 and y_image<=2003-32.003)
 select image_id, number from u where not exists (select 1 from fx_cat2 c where sqrt(power(u.x_image-c.x,2)+power(u.y_image-c.y,2))<=9.003 and r1<18)""")  # fmt: skip
def k04(spark, d):
    cand = transients.candidates(view(spark, d, "fx_det"), _near(spark, d), view(spark, d, "fx_images"), view(spark, d, "fx_cat2"), 60.0, 32.003, 18.0, (("simple", 0.0, 9.003),))
    return cand.select("image_id", "number")


@query("k13_variables", f"select image_id, number from ({_DET}) t join fx_stars s on s.star_id=t.true_star_id where abs(sloan_r-mag_calib)>5.0003*magerr_calib")
def k13(spark, d):
    rows = sql(spark, d, f"select t.*, s.sloan_r as cat_mag from ({_DET}) t join fx_stars s on s.star_id=t.true_star_id")
    return transients.variables(rows, 5.0003).select("image_id", "number")


#: Trails that move a little, with a small deterministic scatter; one candidate per image.
_TRAIL = """select trail_id, trail_id%4 as field_id, number, number as image_id, jd, 150.0e0+trail_id*0.01e0+(jd-2460310.5e0)*1.0e-6*(trail_id%5)+1.0e-6*((number*7919)%13) as ra,
 20.0e0+(jd-2460310.5e0)*2.0e-6*(trail_id%3)+1.0e-6*((number*104729)%11) as dec, 15.0e0+0.01e0*((number*31)%17) as mag_calib, 0.01e0+0.001e0*(number%7) as magerr_calib, 2.0e0+0.01e0*(number%9) as fwhm_image,
 0.01e0+0.001e0*(number%5) as errx2_image, 0.01e0+0.002e0*(number%3) as erry2_image, 30.0e0 as exptime from fx_trails"""


def _linked(rows: str, start: str) -> str:
    """CTEs c_1 and link (id, label): the linking rule, row ids in order of (field, jd, image, number), labels the id of
    the trail's first row. In each round every row takes the nearest free trail that it reaches, as the trails stand
    before it by the labels of the last round, else starts one; rounds end when no label changes. What a row takes hangs
    on earlier rows only, so there is one such labelling, that of linking row by row, and it does not hang on ``start``,
    the columns that group the rows at first. Cells only spare pairs out of reach."""
    return f"""c_1 as materialized (select *, row_number() over (order by field_id, jd, image_id, number) as id, dense_rank() over (partition by field_id order by jd, image_id) as rank from ({rows})),
 c_f as materialized (select field_id, max(rank) as last_rank, max(jd) as last_jd, 30.0/3600/cos(radians(max(abs(dec)))) as reach from c_1 group by 1),
 link(id, label) using key (id) as (select id, min(id) over (partition by {start}) from c_1 union all (
  with a as materialized (select c_1.*, l.label from c_1 join recurring.link l using (id)),
   w as (select *, list({{'t': jd, 'ra': ra, 'dec': dec}}) over r5 as p, row_number() over r as n, lead(rank) over r as next_rank, lead(jd) over r as next_jd from a window r as (partition by label order by id), r5 as (partition by label order by id rows between 4 preceding and current row)),
   h as (select *, list_transform(p, lambda x: (x.t-p[1].t)*24) as h, list_avg(list_transform(p, lambda x: (x.t-p[1].t)*24)) as mh, list_avg(list_transform(p, lambda x: x.ra)) as mra, list_avg(list_transform(p, lambda x: x.dec)) as mdec from w),
   b as (select *, list_sum(list_transform(h, lambda x: (x-mh)*(x-mh))) as hh, list_sum(list_transform(range(1,len(p)+1), lambda i: (h[i]-mh)*(p[i].ra-mra))) as hra, list_sum(list_transform(range(1,len(p)+1), lambda i: (h[i]-mh)*(p[i].dec-mdec))) as hdec from h),
   m as (select *, case when hh>0 then hra/hh else 0 end as vra, case when hh>0 then hdec/hh else 0 end as vdec from b),
   s as materialized (select m.field_id, label, n, rank as from_rank, coalesce(next_rank, last_rank) as to_rank, jd as jd0, ra as ra0, dec as dec0, vra, vdec,
     case when hh>0 then sqrt(power(list_median(list_transform(range(1,len(p)+1), lambda i: abs(p[i].ra-mra-vra*(h[i]-mh)))),2)+power(list_median(list_transform(range(1,len(p)+1), lambda i: abs(p[i].dec-mdec-vdec*(h[i]-mh)))),2))*3600/0.67 else 0 end as sc,
     least(ra, ra+vra*(coalesce(next_jd,last_jd)-jd)*24)-reach as lo, greatest(ra, ra+vra*(coalesce(next_jd,last_jd)-jd)*24)+reach as hi from m join c_f using (field_id)),
   near as (select c.id, s.* from (select *, unnest(range(cast(floor(lo/0.01) as bigint), cast(floor(hi/0.01) as bigint)+1)) as cell from s where hi-lo<0.2) s join (select *, cast(floor(ra/0.01) as bigint) as cell from c_1) c on c.field_id=s.field_id and c.cell=s.cell where c.rank>s.from_rank and c.rank<=s.to_rank
    union all select c.id, s.*, 0 from (select * from s where hi-lo>=0.2) s join c_1 c on c.field_id=s.field_id and c.rank>s.from_rank and c.rank<=s.to_rank),
   d as (select c.id, c.field_id, c.rank, x.label, 3600*sqrt(power((c.ra-ra0-vra*(c.jd-jd0)*24)*cos(radians(c.dec)),2)+power(c.dec-dec0-vdec*(c.jd-jd0)*24,2)) as dist, case when n>=2 then least(3.6+sc*(c.jd-jd0)*24, 30.0) else 3.6 end as radius from near x join c_1 c on c.id=x.id),
   free as (select d.* from (select * from d where dist<radius) d left join a on a.field_id=d.field_id and a.rank=d.rank and a.label=d.label and a.id<d.id where a.id is null),
   best as (select id, arg_min(label, {{'d': dist, 'l': label}}) as label from free group by 1)
  select a.id, coalesce(best.label, a.id) from a left join best using (id) where a.label<>coalesce(best.label, a.id)))"""


#: Each detection with the least number of its trail.
MEMBERS = f"with recursive {_linked(_TRAIL, 'field_id, trail_id')} select field_id, number, min(number) over (partition by label) as trail from c_1 join link using (id)"


def linkable(spark, d):
    return sql(spark, d, _TRAIL).drop("trail_id")


def members(linked):
    return linked.select("field_id", "number", F.min("number").over(Window.partitionBy("field_id", "trail_id")).alias("trail"))


@query("f03_link_trails", MEMBERS)
def f03(spark, d):
    return members(transients.link_trails(linkable(spark, d)))


@query("f02_motion_state", f"""with t as ({_TRAIL}), w as (select trail_id, number, regr_slope(ra, (jd-2460310.5)*24) over r as mra, regr_slope(dec, (jd-2460310.5)*24) over r as mdec, count(*) over r as k from t window r as (partition by trail_id order by jd, number rows between 4 preceding and current row))
 select trail_id, number, round(case when k>=2 then mra*3600 else 0 end,3)+0.0 as motion_ra, round(case when k>=2 then mdec*3600 else 0 end,3)+0.0 as motion_dec from w""")  # fmt: skip
def f02(spark, d):
    return transients.motion_state(sql(spark, d, _TRAIL)).select("trail_id", "number", (F.round("motion_ra", 3) + 0.0).alias("motion_ra"), (F.round("motion_dec", 3) + 0.0).alias("motion_dec"))


@query("f04_variability", f"""with t as ({_TRAIL}), m as (select trail_id, sum(mag_calib/(magerr_calib*magerr_calib))/sum(1/(magerr_calib*magerr_calib)) as mag0 from t group by 1),
 v as (select t.trail_id, sum(power((mag_calib-mag0)/magerr_calib,2)) as c, sum(1/(magerr_calib*magerr_calib)) as w, count(*) as n from t join m using (trail_id) group by 1),
 s as (select trail_id, sqrt(case when c/(n-1)>3 then c/w*c/(n-1) else c/w end) as magvar, n from v),
 l as (select trail_id, abs(mag_calib-lag(mag_calib) over o)/sqrt(power(greatest(magerr_calib,0.001),2)+power(greatest(lag(magerr_calib) over o,0.001),2)) as x from t window o as (partition by trail_id order by jd, number))
 select l.trail_id, round(sum(x)*any_value(n)/(any_value(n)-1)/any_value(magvar),3) as variability from l join s using (trail_id) group by 1""")  # fmt: skip
def f04(spark, d):
    trails = sql(spark, d, _TRAIL)
    return transients.variability(trails, transients.mag_stats(trails)).select("trail_id", F.round("variability", 3).alias("variability"))


@query("f05_gaps", f"with t as ({_TRAIL}), g as (select trail_id, (jd-lag(jd) over (partition by trail_id order by jd, number))*24 as g from t) select trail_id, round(coalesce(max(g),0),4) as max_gap, round(coalesce(avg(g),0),4) as avg_gap from g group by 1")
def f05(spark, d):
    return transients.gaps(sql(spark, d, _TRAIL)).select("trail_id", F.round("max_gap", 4).alias("max_gap"), F.round("avg_gap", 4).alias("avg_gap"))


@query("k05_motion_fit", f"""with t as ({_TRAIL}), f as (select field_id, min(m) as lo, max(m) as hi from (select field_id, trail_id, min(jd) as m from t group by 1,2) group by 1),
 h as (select t.*, (jd-(lo+hi)/2)*24 as h from t join f using (field_id)), r as (select trail_id, count(*) as num, regr_slope(ra,h) as ba, regr_intercept(ra,h) as a0, regr_slope(dec,h) as bd, regr_intercept(dec,h) as d0 from h group by 1),
 s as (select trail_id, median(abs(ra-a0-ba*h))/0.67*3600 as sa, median(abs(dec-d0-bd*h))/0.67*3600 as sd from h join r using (trail_id) group by 1)
 select trail_id, num, round(a0,6) as a0, round(d0,6) as d0, round(ba*3600,4)+0.0 as da, round(bd*3600,4)+0.0 as dd, round(sa,4) as sa, round(sd,4) as sd from r join s using (trail_id)""")  # fmt: skip
def k05(spark, d):
    out = transients.motion_fit(sql(spark, d, _TRAIL))
    return out.select("trail_id", "num", F.round("a0", 6).alias("a0"), F.round("d0", 6).alias("d0"), *[(F.round(c, 4) + 0.0).alias(c) for c in ("da", "dd", "sa", "sd")])


@query("k05_motion_fit_weighted", f"""with t as (select *, 1/((errx2_image+erry2_image)*4.0) as w from ({_TRAIL})), f as (select field_id, min(m) as lo, max(m) as hi from (select field_id, trail_id, min(jd) as m from t group by 1,2) group by 1),
 h as (select t.*, (jd-(lo+hi)/2)*24 as h from t join f using (field_id)), m as (select trail_id, sum(w) as sw, sum(w*h)/sum(w) as mh, sum(w*ra)/sum(w) as ma from h group by 1),
 b as (select trail_id, any_value(mh) as mh, any_value(ma) as ma, sum(w*(h-mh)*(ra-ma))/sum(w*(h-mh)*(h-mh)) as ba from h join m using (trail_id) group by 1)
 select trail_id, round(ma-ba*mh,6) as a0, round(ba*3600,4)+0.0 as da from b""")  # fmt: skip
def k05_weighted(spark, d):
    return transients.motion_fit(sql(spark, d, _TRAIL), astvar=4.0).select("trail_id", F.round("a0", 6).alias("a0"), (F.round("da", 4) + 0.0).alias("da"))


@query("k07_mag_stats", f"""with t as ({_TRAIL}), m as (select trail_id, sum(mag_calib/(magerr_calib*magerr_calib))/sum(1/(magerr_calib*magerr_calib)) as mag0 from t group by 1),
 v as (select t.trail_id, any_value(mag0) as mag0, sum(power((mag_calib-mag0)/magerr_calib,2)) as c, sum(1/(magerr_calib*magerr_calib)) as w, count(*) as n from t join m using (trail_id) group by 1)
 select trail_id, round(mag0,6) as mag0, round(sqrt(case when c/(n-1)>3 then c/w*c/(n-1) else c/w end),6) as magvar, n as num from v""")  # fmt: skip
def k07(spark, d):
    return transients.mag_stats(sql(spark, d, _TRAIL)).select("trail_id", F.round("mag0", 6).alias("mag0"), F.round("magvar", 6).alias("magvar"), "num")


@query("k07_mag_stats_legacy", f"""with t as ({_TRAIL}), m as (select trail_id, sum(mag_calib*magerr_calib)/sum(magerr_calib) as mag0 from t group by 1)
 select t.trail_id, round(any_value(mag0),6) as mag0, round(sqrt(avg(power((mag_calib-mag0)/magerr_calib,2))),6) as magvar, count(*) as num from t join m using (trail_id) group by 1""")  # fmt: skip
def k07_legacy(spark, d):
    return transients.mag_stats(sql(spark, d, _TRAIL), legacy=True).select("trail_id", F.round("mag0", 6).alias("mag0"), F.round("magvar", 6).alias("magvar"), "num")


#: Scores of all kinds, derived from the image table.
_SCORE = "select image_id as trail_id, 0.5e0*(image_id%13) as significance, 0.5e0*(image_id%13) as dpos, 1.0e0+(image_id%2) as sigma, 0.4e0*(image_id%11)+0.1e0 as magvar, 1.5e0*(image_id%10) as max_gap, 0.03e0*(image_id%9) as fwhm_consistency, image_id%10 as num, 0.3e0*(image_id%4) as variability from fx_images"


@query("k06_status_flags", f"select trail_id, (case when significance>5 then 'P' when significance>2 then 'p' else '!' end)||(case when dpos>3*sigma then 'M' when dpos>2*sigma then 'm' else '!' end)||(case when magvar<2 then 'V' when magvar<3 then 'v' else '!' end)||'!' as status from ({_SCORE})")
def k06(spark, d):
    return transients.status_flags(sql(spark, d, _SCORE)).select("trail_id", "status")


@query("k08_ot_ness", f"select trail_id, round(case when significance=0 or variability=0 then null else 10/significance*magvar/variability end,6) as ot_ness from ({_SCORE})")
def k08(spark, d):
    return transients.ot_ness(sql(spark, d, _SCORE)).select("trail_id", F.round("ot_ness", 6).alias("ot_ness"))


@query("k09_mp_ness", f"""select trail_id, round(10.0*case when significance>5 then significance*2 when significance>2 then significance else 1/greatest(0.1,significance) end*case when magvar<1.5 then 4/(magvar+0.1) when magvar<3 then 2/(magvar+0.1) else 1/(magvar*magvar) end
 *case when max_gap>12 then 1/power(max_gap/12,2) when max_gap>6 then 6/max_gap else 1 end*case when fwhm_consistency<0.1 then 3 when fwhm_consistency<0.2 then 1.5 else 1/(fwhm_consistency*10) end*case when num/10.0>0.8 then 2 when num/10.0>0.6 then 1.5 else 1 end,4) as mp_ness from ({_SCORE})""")  # fmt: skip
def k09(spark, d):
    return transients.mp_ness(sql(spark, d, _SCORE), 10).select("trail_id", F.round("mp_ness", 4).alias("mp_ness"))


@query("k10_object_type", "select image_id as trail_id, case when o>10 and o>m then 'OT' when m>10 and m>o then 'MP' when s>2 then 'MV' else '??' end as object_type from (select image_id, 3*(image_id%7) as o, 4*(image_id%6) as m, image_id%5 as s from fx_images)")
def k10(spark, d):
    rows = sql(spark, d, "select image_id as trail_id, 3.0e0*(image_id%7) as ot_ness, 4.0e0*(image_id%6) as mp_ness, image_id%5 as significance from fx_images")
    return transients.object_type(rows).select("trail_id", "object_type")


@query("k11_trail_summary", f"""with t as ({_TRAIL}), w as (select trail_id, jd, number, regr_slope(ra, (jd-2460310.5)*24) over r as mra, regr_slope(dec, (jd-2460310.5)*24) over r as mdec from t window r as (partition by trail_id order by jd, number rows between 4 preceding and current row)),
 l as (select *, count(*) over (partition by trail_id) as n, row_number() over (partition by trail_id order by jd desc, number desc) as k from w)
 select count(*) as trails, count(case when n=1 then 1 end) as single, count(case when n>1 then 1 end) as multiple, count(case when n>=3 then 1 end) as three_plus, count(case when n>1 and 3600*sqrt(coalesce(mra,0)*coalesce(mra,0)+coalesce(mdec,0)*coalesce(mdec,0))>0.005 then 1 end) as moving from l where k=1""")  # fmt: skip
def k11(spark, d):
    return transients.trail_summary(sql(spark, d, _TRAIL), 0.005)


@query("k12_light_curves", f"with t as ({_TRAIL}) select trail_id, number, round((jd-2460310.5)*86400+15,3) as t, 15.0 as half_exposure from t where trail_id%7 in (0,3)")
def k12(spark, d):
    trails = sql(spark, d, _TRAIL)
    scores = trails.select("trail_id").distinct().withColumns({"ot_ness": F.when(F.col("trail_id") % 7 == 0, 3.0), "mp_ness": F.when(F.col("trail_id") % 7 == 3, 11.0).otherwise(1.0), "object_type": F.lit("OT")})
    named = transients.light_curves(trails, scores, 2460310.5)
    return named.join(trails.select("trail_id", "jd", "number"), ["trail_id", "jd"]).select("trail_id", "number", F.round("t", 3).alias("t"), "half_exposure")


#: Columns of a score with what both sides print them as: places after the point, or digits.
_PRINT = {"num": None, "fwhm_mean": 9, "fwhm_consistency": 9, "a0": 9, "d0": 9, "da": "e", "dd": "e", "sa": "e", "sd": "e", "dpos": "e", "sigma": "e", "significance": "e", "mag0": 9, "magvar": "e", "variability": "e", "max_gap": 4, "avg_gap": 4, "ot_ness": "e", "mp_ness": "e", "status": None, "object_type": None}


def _score_sql(source: str, weighted: bool, n_images: str) -> str:
    """All columns of ``score_trails`` for trails of at least three of ``source``'s rows, as CTEs that end in ``z``."""
    line = lambda c, m, b: f"({c}-{m}-{b}*(h-mh))"
    ra, dec = line("ra", "ma", "ba"), line("dec", "md", "bd")
    if weighted:
        spread = lambda c, p: f"case when num>2 then case when {c}/(num-2)>3 then sqrt({c}/sw*{c}/(num-2)) else sqrt({c}/sw) end else {p} end*3600"
        rest = f"sum(w*{ra}*{ra}) as ca, sum(w*{dec}*{dec}) as cd, stddev_pop({ra}) as pa, stddev_pop({dec}) as pd"
        sa, sd, light = spread("ca", "pa"), spread("cd", "pd"), "sqrt(case when c/(n-1)>3 then c/iw*c/(n-1) else c/iw end)"
        weight, mean = "1/((errx2_image+erry2_image)*4.0)", "sum(mag_calib/(magerr_calib*magerr_calib))/sum(1/(magerr_calib*magerr_calib))"
    else:
        rest, sa, sd = f"median(abs({ra})) as ca, median(abs({dec})) as cd", "ca/0.67*3600", "cd/0.67*3600"
        weight, mean, light = "1.0", "sum(mag_calib*magerr_calib)/sum(magerr_calib)", "sqrt(c/n)"
    return f"""t as materialized ({source}), s_w as (select *, {weight} as w from t), s_f as (select field_id, min(m) as lo, max(m) as hi from (select field_id, trail_id, min(jd) as m from t group by 1,2) group by 1),
 s_h as materialized (select s_w.*, (jd-(lo+hi)/2)*24 as h, (hi-lo)*24 as span from s_w join s_f using (field_id)), s_m as (select trail_id, count(*) as num, sum(w) as sw, sum(w*h)/sum(w) as mh, sum(w*ra)/sum(w) as ma, sum(w*dec)/sum(w) as md, any_value(span) as span from s_h group by 1),
 s_b as (select trail_id, coalesce(sum(w*(h-mh)*(ra-ma))/nullif(sum(w*(h-mh)*(h-mh)),0),0) as ba, coalesce(sum(w*(h-mh)*(dec-md))/nullif(sum(w*(h-mh)*(h-mh)),0),0) as bd from s_h join s_m using (trail_id) group by 1),
 s_r as (select trail_id, {rest} from s_h join s_m using (trail_id) join s_b using (trail_id) group by 1),
 s_p as (select trail_id, num, ma-ba*mh as a0, md-bd*mh as d0, ba*3600 as da, bd*3600 as dd, {sa} as sa, {sd} as sd, span from s_m join s_b using (trail_id) join s_r using (trail_id)),
 s_q as (select *, sqrt(dd*dd+da*da*power(cos(radians(d0)),2))*span as dpos, sqrt(sd*sd+sa*sa*power(cos(radians(d0)),2)) as sigma from s_p),
 s_0 as (select trail_id, {mean} as mag0 from t group by 1), s_v as (select t.trail_id, any_value(mag0) as mag0, sum(power((mag_calib-mag0)/magerr_calib,2)) as c, sum(1/(magerr_calib*magerr_calib)) as iw, count(*) as n from t join s_0 using (trail_id) group by 1),
 s_l as (select trail_id, mag0, {light} as magvar, n from s_v where n>=3),
 s_g as (select trail_id, fwhm_image, (jd-lag(jd) over o)*24 as gap, abs(mag_calib-lag(mag_calib) over o)/sqrt(power(greatest(magerr_calib,0.001),2)+power(greatest(lag(magerr_calib) over o,0.001),2)) as x from t window o as (partition by trail_id order by jd, number)),
 s_a as (select trail_id, avg(fwhm_image) as fwhm_mean, stddev_pop(fwhm_image)/avg(fwhm_image) as fwhm_consistency, coalesce(max(gap),0) as max_gap, coalesce(avg(gap),0) as avg_gap, sum(x) as x from s_g group by 1),
 s_x as (select *, case when sigma>0 then dpos/sigma else 0 end as significance, x*n/(n-1)/nullif(magvar,0) as variability from s_q join s_l using (trail_id) join s_a using (trail_id)),
 s_y as (select *, 10/nullif(significance,0)*magvar/nullif(variability,0) as ot_ness,
  10.0*case when significance>5 then significance*2 when significance>2 then significance else 1/greatest(0.1,significance) end*case when magvar<1.5 then 4/(magvar+0.1) when magvar<3 then 2/(magvar+0.1) else 1/(magvar*magvar) end
  *case when max_gap>12 then 1/power(max_gap/12,2) when max_gap>6 then 6/max_gap else 1 end*case when fwhm_consistency<0.1 then 3 when fwhm_consistency<0.2 then 1.5 else 1/(fwhm_consistency*10) end*case when num/({n_images})>0.8 then 2 when num/({n_images})>0.6 then 1.5 else 1 end as mp_ness,
  (case when significance>5 then 'P' when significance>2 then 'p' else '!' end)||(case when dpos>3*sigma then 'M' when dpos>2*sigma then 'm' else '!' end)||(case when magvar<2 then 'V' when magvar<3 then 'v' else '!' end)||'!' as status from s_x),
 z as (select *, case when coalesce(ot_ness,0)>10 and coalesce(ot_ness,0)>coalesce(mp_ness,0) then 'OT' when coalesce(mp_ness,0)>10 and coalesce(mp_ness,0)>coalesce(ot_ness,0) then 'MP' when significance>2 then 'MV' else '??' end as object_type from s_y)"""


_SHOWN = ", ".join(c if how is None else f"printf('%.4e', {c}+0.0) as {c}" if how == "e" else f"round({c},{how})+0.0 as {c}" for c, how in _PRINT.items())


def _shown(scores):
    shown = [F.col(c) if how is None else F.format_string("%.4e", F.col(c) + 0.0).alias(c) if how == "e" else (F.round(c, how) + 0.0).alias(c) for c, how in _PRINT.items()]
    shown = [F.when(F.col(c).isNotNull(), x).alias(c) if _PRINT[c] == "e" else x for c, x in zip(_PRINT, shown)]
    return scores.select("trail_id", *shown)


@query("k_score_trails", f"with {_score_sql(_TRAIL, True, '10.0')} select trail_id, {_SHOWN} from z")
def k_scores(spark, d):
    """The whole table of scores, each column held."""
    return _shown(transients.score_trails(sql(spark, d, _TRAIL), 10, 3, astvar=4.0))


@query("k_find_transients")
def k_find(spark, d):
    det = sql(spark, d, "select d.*, mag_auto+22 as mag_calib, magerr_auto as magerr_calib, s.radeg as alpha_j2000, s.decdeg as delta_j2000 from fx_det d join fx_stars s on s.star_id=d.true_star_id")
    return pipelines.find_transients(det, view(spark, d, "fx_stars0"), view(spark, d, "fx_images"), view(spark, d, "fx_cat2"), R, 60.0, 18.0)["scores"]


#: Slow movers, one for each nation, in the images of a field; their pixels fall anywhere, so stars hide some.
_MOVERS = """select i.image_id, cast(-(n.n_nationkey+1) as bigint) as number, n.n_nationkey as mover, 100.0e0+((n.n_nationkey*7919+i.image_id*10007)%18013)*0.1e0 as x_image, 100.0e0+((n.n_nationkey*104729+i.image_id*5003)%18017)*0.1e0 as y_image,
 150.0e0+n.n_nationkey*0.2e0+(i.jd-2460310.5e0)*24*(n.n_nationkey%4)*0.1e0/3600+1.0e-6*((i.image_id*7919+n.n_nationkey)%13) as alpha_j2000, 20.0e0-(i.jd-2460310.5e0)*24*(n.n_nationkey%3)*0.1e0/3600+1.0e-6*((i.image_id*104729+n.n_nationkey)%11) as delta_j2000,
 16.0e0+0.01e0*((i.image_id*31+n.n_nationkey)%17) as mag_calib, 0.01e0+0.001e0*(i.image_id%5) as magerr_calib, 0.01e0+0.001e0*(i.image_id%5) as magerr_auto, 2.0e0+0.01e0*((i.image_id+n.n_nationkey)%9) as fwhm_image, 0.01e0 as errx2_image, 0.01e0 as erry2_image
 from fx_images i join nation n on n.n_nationkey%4=i.field_id"""
_PLANTED = f"""select c.*, i.field_id, i.jd, alpha_j2000 as ra, delta_j2000 as dec from ({_MOVERS}) c join fx_images i using (image_id) where magerr_auto<1.091/60 and x_image>=32.0 and y_image>=32.0 and x_image<=imgaxis1-32.0 and y_image<=imgaxis2-32.0
 and not exists (select 1 from fx_stars0 s where power(c.x_image-s.cat_x,2)+power(c.y_image-s.cat_y,2)<=2.003*2.003)
 and not exists (select 1 from fx_cat2 v where power(c.x_image-v.x,2)+power(c.y_image-v.y,2)<=power(2.003*10/3,2) and (r1<18.0-5 or r1<18.0-1 and power(c.x_image-v.x,2)+power(c.y_image-v.y,2)<=power(2.003*4/3,2) or r1<18.0 and power(c.x_image-v.x,2)+power(c.y_image-v.y,2)<=2.003*2.003))"""
_FOUND = "select c_1.*, field_id||'-'||(dense_rank() over (partition by field_id order by label)-1) as trail_id from c_1 join link using (id)"


@query("k_find_planted", f"with recursive {_linked(_PLANTED, 'mover')}, {_score_sql(_FOUND, False, '(select count(*) from fx_images)::double')} select trail_id, {_SHOWN} from z")
def k_planted(spark, d):
    """The whole run on movers among stars that all have their place in the catalogue: what is found is what linking
    makes of the movers that no star hides, with every score."""
    still = sql(spark, d, "select d.image_id, d.number, s.cat_x as x_image, s.cat_y as y_image, t.radeg as alpha_j2000, t.decdeg as delta_j2000, 15.0e0 as mag_calib, magerr_auto as magerr_calib, magerr_auto, fwhm_image, errx2_image, erry2_image from fx_det d join fx_stars0 s on s.star_id=d.true_star_id join fx_stars t on t.star_id=d.true_star_id")
    det = still.unionByName(sql(spark, d, _MOVERS).drop("mover"))
    return _shown(pipelines.find_transients(det, view(spark, d, "fx_stars0"), view(spark, d, "fx_images"), view(spark, d, "fx_cat2"), R, 60.0, 18.0)["scores"])

"""C: predicates; G and H: sorts, first rows and set operations; J: filters and schemas; A: tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import sql, view
from ..functions import bands
from ..operators import calib, filterdim, filters, match
from ..sources import archive, tables
from . import query

_V = "cos(radians(decdeg))*cos(radians(radeg)) as x, cos(radians(decdeg))*sin(radians(radeg)) as y, sin(radians(decdeg)) as z"


@query("c01_in_rect", f"""select star_id from (select star_id, {_V} from fx_stars) where abs(-sin(radians(150.05))*x+cos(radians(150.05))*y)<=sin(radians(0.1))
 and abs(-sin(radians(20.02))*cos(radians(150.05))*x-sin(radians(20.02))*sin(radians(150.05))*y+cos(radians(20.02))*z)<=sin(radians(0.07))""")  # fmt: skip
def c01(spark, d):
    return filters.in_rect(view(spark, d, "fx_stars"), 150.05, 20.02, 0.1, 0.07).select("star_id")


@query("c02_in_circle", f"select star_id from (select star_id, {_V} from fx_stars) where cos(radians(20.02))*cos(radians(150.05))*x+cos(radians(20.02))*sin(radians(150.05))*y+sin(radians(20.02))*z>=cos(radians(0.1))")
def c02(spark, d):
    return filters.in_circle(view(spark, d, "fx_stars"), 150.05, 20.02, 0.1).select("star_id")


@query("c03_in_box", "select star_id from (select star_id, decdeg, (radeg-150.1+360.0)%360.0 as a from fx_stars) where decdeg between -90 and 90 and decdeg between 20.0-0.1 and 20.0+0.1 and (a<=0.08/cos(radians(20.0)) or a>=360-0.08/cos(radians(20.0)))")
def c03(spark, d):
    stars = view(spark, d, "fx_stars").withColumn("radeg", F.pmod(F.col("radeg") - 150.1, F.lit(360.0)))  # the box crosses 0
    return filters.in_box(stars, 0.0, 20.0, 0.16, 0.2).select("star_id")


@query("c04_cone", "select star_id from fx_stars where 2*degrees(asin(sqrt(power(sin(radians(decdeg-20.02)/2),2)+cos(radians(decdeg))*cos(radians(20.02))*power(sin(radians(radeg-150.05)/2),2))))<0.1")
def c04(spark, d):
    return filters.cone(view(spark, d, "fx_stars"), 150.05, 20.02, 0.1).select("star_id")


@query("c05_bright_isolated", "select star_id from fx_stars where least(sloan_g,sloan_r,sloan_i)<=60.0 and star_id%31>=10")
def c05(spark, d):
    return filters.bright_isolated(view(spark, d, "fx_stars").withColumn("rp1", F.col("star_id") % 31), 60.0, 10).select("star_id")


@query("c06_quality_cut", "select star_id from fx_stars where 1.0+(star_id%10)*0.05<1.4 and star_id%12>=8 and star_id%9<>0 and star_id%5>0")
def c06(spark, d):
    stars = sql(spark, d, "select star_id, 1.0e0+(star_id%10)*0.05e0 as ruwe, star_id%12 as visibility_periods_used, case when star_id%9<>0 then sloan_g end as bp, sloan_r as g, sloan_i as rp, star_id%5 as g_snr, 1 as bp_snr, 2 as rp_snr from fx_stars")
    return filters.quality_cut(stars, "gaia").select("star_id")


@query("c06_quality_cut_panstarrs", "select star_id from fx_stars where star_id%4>1 and star_id%200<128 and star_id%9<>0")
def c06_ps(spark, d):
    stars = sql(spark, d, "select star_id, star_id%4 as n_detections, star_id%200 as quality_flag, case when star_id%9<>0 then sloan_g end as g, sloan_r as r, sloan_i as i, sloan_z as z, j as y from fx_stars")
    return filters.quality_cut(stars, "panstarrs").select("star_id")


@query("c07_mag_limits", "select star_id from fx_stars where sloan_r<=50.003 and sloan_r>=20.003")
def c07(spark, d):
    return filters.mag_limits(view(spark, d, "fx_stars"), 50.003, 20.003, "sloan_r").select("star_id")


@query("c08_color_limits", "select star_id from fx_stars where greatest(sloan_g-sloan_r,sloan_r-sloan_i,sloan_i-sloan_z)<=0.80001 and least(sloan_g-sloan_r,sloan_r-sloan_i,sloan_i-sloan_z)>=0.04001")
def c08(spark, d):
    stars = bands.schema_colors(view(spark, d, "fx_stars"), ["sloan_g", "sloan_r", "sloan_i", "sloan_z", "j"])
    return filters.color_limits(stars, 0.80001, 0.04001).select("star_id")


@query("c09_exclude_target", "select image_id, number from fx_det where not (image_id%2=0 and sqrt(power(x_image-500.003,2)+power(y_image-600.003,2))<300.0)")
def c09(spark, d):
    targets = sql(spark, d, "select image_id, 500.003e0 as target_x, 600.003e0 as target_y from fx_images where image_id%2=0")
    return filters.exclude_target(view(spark, d, "fx_det"), targets, 300.0).select("image_id", "number")


@query("c10_quality_detections", "select image_id, case when number%1000=7 then 0 else number end as number, count(*) as n from fx_det where (flags=0 and magerr_auto<1.091/2) or number%1000=7 group by 1,2")
def c10(spark, d):
    det = view(spark, d, "fx_det").withColumn("is_target", F.col("number") % 1000 == 7)
    return filters.quality_detections(det).groupBy("image_id", "number").agg(F.count(F.lit(1)).alias("n"))


@query("c11_inside_frame", "select image_id, number from fx_det where x_image>=50.005 and y_image>=50.005 and x_image<=2002-50.005 and y_image<=2003-50.005")
def c11(spark, d):
    rows = view(spark, d, "fx_det").join(view(spark, d, "fx_images").select("image_id", "imgaxis1", "imgaxis2"), "image_id")
    return filters.inside_frame(rows, 50.005).select("image_id", "number")


@query("c12_check_wcs", "select image_id, true as sky_ok, image_id%10=9 as needs_solving from (select image_id from fx_images where image_id%10<>9) union all select image_id, false, true from fx_images where image_id%10=9")
def c12(spark, d):
    images = sql(spark, d, "select image_id, imgaxis1, imgaxis2, case when image_id%10<>9 then 150.0e0 end as crval1, 20.0e0 as crval2, 1000.0e0 as crpix1, 1000.0e0 as crpix2, -0.0003e0 as cd1_1, 0.0e0 as cd1_2, 0.0e0 as cd2_1, 0.0003e0 as cd2_2 from fx_images")
    return filters.check_wcs(images).select("image_id", "sky_ok", "needs_solving")


@query("c13_missing_keys", "select image_id, case when image_id%10=9 then 'magzero,naxis' else 'naxis' end as missing_required, '' as missing_soft from fx_images")
def c13(spark, d):
    rows = filters.missing_keys(view(spark, d, "fx_images"), ["jd", "magzero", "naxis"], ["filter"])
    return rows.select("image_id", F.array_join("missing_required", ",").alias("missing_required"), F.array_join("missing_soft", ",").alias("missing_soft"))


@query("c14_early", "select image_id from fx_images where field_id=3 or jd-(2460310.0+field_id*0.1)<=1.0005")
def c14(spark, d):
    events = sql(spark, d, "select distinct field_id, 2460310.0e0+field_id*0.1e0 as t0 from fx_images where field_id<3")
    return filters.early(view(spark, d, "fx_images"), events, 1.0005).select("image_id")


@query("c15_subsample", "select image_id, number from (select *, row_number() over (partition by image_id order by md5(cast(image_id as varchar)||'/'||cast(number as varchar)||'/7'), number) as r from fx_det) where r<=20")
def c15(spark, d):
    return filters.subsample(view(spark, d, "fx_det"), 20, 7).select("image_id", "number")


@query("c16_tiles_rect", """with f as (select image_id as field_id, (image_id*37.3e0)%360.0e0 as ra0, ((image_id*11.7e0)%120.0e0)-60.0e0 as dec0, 1.31e0 as da, 0.87e0 as dd from fx_images),
 t as (select i.i, j.j from (select unnest(range(0,360)) as i) i, (select unnest(range(0,180)) as j) j),
 p as (select f.*, radians(ra0) as a, radians(dec0) as d from f),
 m0 as (select field_id, i, j from p join t on abs(j-90-dec0)<4 where exists (select 1 from (values (0,0),(0,1),(1,0),(1,1)) c(u,v) where
   abs(-sin(a)*cos(radians(j-90+v))*cos(radians(i+u))+cos(a)*cos(radians(j-90+v))*sin(radians(i+u)))<=sin(radians(da))
   and abs(-sin(d)*cos(a)*cos(radians(j-90+v))*cos(radians(i+u))-sin(d)*sin(a)*cos(radians(j-90+v))*sin(radians(i+u))+cos(d)*sin(radians(j-90+v)))<=sin(radians(dd))
   and cos(d)*cos(a)*cos(radians(j-90+v))*cos(radians(i+u))+cos(d)*sin(a)*cos(radians(j-90+v))*sin(radians(i+u))+sin(d)*sin(radians(j-90+v))>=0)),
 k as (select field_id, a, d, s*sin(radians(da)) as e, w*sin(radians(dd)) as n, sqrt(1-power(sin(radians(da)),2)-power(sin(radians(dd)),2)) as c from p, (values (1,1),(1,-1),(-1,1),(-1,-1)) q(s,w)),
 kv as (select field_id, c*cos(d)*cos(a)-e*sin(a)-n*sin(d)*cos(a) as x, c*cos(d)*sin(a)+e*cos(a)-n*sin(d)*sin(a) as y, c*sin(d)+n*cos(d) as z from k),
 m1 as (select field_id, i, j from m0 union select field_id, cast(floor((degrees(atan2(y,x))+360)%360+1e-8) as bigint)%360, cast(floor(degrees(asin(z))+1e-8) as bigint)+90 from kv),
 b as (select field_id, j, min(i) as lo, max(i) as hi from m1 group by 1,2),
 m2 as (select field_id, i, j from m1 union select b.field_id, t.i, b.j from b join t on t.j=b.j where case when hi-lo>180 then t.i>=hi or t.i<=lo else t.i between lo and hi end),
 c as (select field_id, i, min(j) as lo, max(j) as hi from m2 group by 1,2),
 m3 as (select field_id, i, j from m2 union select c.field_id, c.i, t.j from c join t on t.i=c.i and t.j between lo and hi)
 select distinct field_id, cast(i+360*j as int) as tile from m3""")  # fmt: skip
def c16(spark, d):
    return filters.tiles_for(sql(spark, d, "select image_id as field_id, (image_id*37.3e0)%360.0e0 as ra0, ((image_id*11.7e0)%120.0e0)-60.0e0 as dec0, 1.31e0 as da, 0.87e0 as dd from fx_images"))


@query("c17_min_found", "select trail_id, number from fx_trails where trail_id in (select trail_id from fx_trails group by 1 having count(*)>=70)")
def c17(spark, d):
    return filters.min_found(view(spark, d, "fx_trails"), 70).select("trail_id", "number")


@query("g01_sort_by_mag", "select star_id, sloan_r from fx_stars order by sloan_r, star_id")
def g01(spark, d):
    return calib.sort_by_mag(view(spark, d, "fx_stars").select("star_id", "sloan_r"), "sloan_r")


@query("g02_sort_by_number", "select image_id, number from fx_det order by image_id, number")
def g02(spark, d):
    return calib.sort_by_number(view(spark, d, "fx_det").select("image_id", "number"))


@query("g03_first_k", "select image_id, number from (select *, row_number() over (partition by image_id order by number) as r from fx_det) where r<=100")
def g03(spark, d):
    return match.first_k(view(spark, d, "fx_det"), 100, "number").select("image_id", "number")


@query("f08_top_bright", "select image_id, number from (select *, row_number() over (partition by image_id order by mag_auto, number) as r from fx_det) where r<=30")
def f08(spark, d):
    return match.top_bright(view(spark, d, "fx_det")).select("image_id", "number")


@query("h01_stack", "select star_id as id, sloan_r, null::double as r1 from fx_stars union all select usno_id, null, r1 from fx_cat2")
def h01(spark, d):
    return calib.stack(view(spark, d, "fx_stars").select(F.col("star_id").alias("id"), "sloan_r"), view(spark, d, "fx_cat2").select(F.col("usno_id").alias("id"), "r1"))


@query("h02_missing_filters", "select image_id, case when filter in ('Sloan_r','r') then 'Sloan_g' else 'Sloan_g,Sloan_r' end as missing_filters from fx_images where filter<>'Sloan_g' union all select image_id, 'Sloan_r' from fx_images where filter='Sloan_g'")
def h02(spark, d):
    rows = view(spark, d, "fx_images").withColumns({"required": F.array(F.lit("Sloan_g"), F.lit("Sloan_r")), "available": F.array(F.when(F.col("filter") == "r", "Sloan_r").otherwise(F.col("filter")))})
    return calib.missing_filters(rows).select("image_id", F.array_join("missing_filters", ",").alias("missing_filters"))


@query("h04_drop_keys", "select image_id, number from fx_det where image_id%3<>0")
def h04(spark, d):
    return calib.drop_keys(view(spark, d, "fx_det").select("image_id", "number"), view(spark, d, "fx_images").where("image_id%3=0").select("image_id"))


@query("j01_closest_filter", "select image_id, case when image_id%5=4 then null when w<=5490 then 'Sloan_g' when w<=6845 then 'Sloan_r' else 'Sloan_i' end as closest from (select image_id, 4003+(image_id*37)%4000 as w from fx_images)")
def j01(spark, d):
    rows = sql(spark, d, "select image_id, case when image_id%5<>4 then 4003+(image_id*37)%4000 end as target_wl from fx_images")
    three = filterdim.filters_dim(spark, "atlas").where(F.col("filter_name").isin("Sloan_g", "Sloan_r", "Sloan_i"))
    return filterdim.closest_filter(rows, three).select("image_id", "closest")


@query("j02_base_filter", "select image_id, case filter when 'Sloan_g' then 'Sloan_g' when 'Sloan_r' then 'Sloan_r' when 'r' then 'Sloan_r' else 'Johnson_R' end as base_filter from fx_images")
def j02(spark, d):
    return filterdim.base_filter(view(spark, d, "fx_images"), filterdim.filters_dim(spark, "atlas")).select("image_id", "base_filter")


@query("j03_compatible_schema", "select distinct case filter when 'Sloan_g' then 'Sloan_g' when 'Sloan_r' then 'Sloan_r' when 'r' then 'Sloan_r' else 'Johnson_R' end as base_filter, case when filter='R' then 'JohnsonJ' else 'SloanJ' end as schema_name from fx_images")
def j03(spark, d):
    atlas = filterdim.filters_dim(spark, "atlas")
    return filterdim.compatible_schema(atlas, filterdim.schemas_dim(spark), filterdim.base_filter(view(spark, d, "fx_images"), atlas))


@query("j04_assign_filters", "select image_id, case filter when 'Sloan_g' then 'Sloan_g' when 'R' then 'Johnson_R' else 'Sloan_r' end as phfilter, case when filter='R' then 'Vega' else 'AB' end as phsystem, case when filter='R' then 'JohnsonJ' else 'SloanJ' end as phschema from fx_images")
def j04(spark, d):
    rows = filterdim.assign_filters(view(spark, d, "fx_images"), filterdim.filters_dim(spark, "atlas"), filterdim.schemas_dim(spark))
    return rows.select("image_id", "phfilter", "phsystem", "phschema")


@query("j05_override_schema", "select image_id, 'Johnson_V' as phfilter, 'Vega' as phsystem, 'JohnsonJ' as phschema from fx_images")
def j05(spark, d):
    rows = filterdim.assign_filters(view(spark, d, "fx_images"), filterdim.filters_dim(spark, "atlas"), filterdim.schemas_dim(spark), "JohnsonJ")
    return rows.select("image_id", "phfilter", "phsystem", "phschema")


@query("a05_normalize_catalog", "select star_id::double as star_id, round(radeg,9) as ra, round(pmra*1e6/3.6e6,12) as pmra, 0.0e0 as pmdec from fx_stars")
def a05(spark, d):
    rows = view(spark, d, "fx_stars").selectExpr("star_id", "radeg", "pmra*1e6 as pm1")
    out = tables.normalize_catalog(rows, {"star_id": "star_id", "ra": "radeg", "pmra": "pm1", "pmdec": "none"})
    return out.select("star_id", F.round("ra", 9).alias("ra"), F.round("pmra", 12).alias("pmra"), "pmdec")


@query("a07_parse_results", "select 'img'||cast(image_id as varchar)||'.fits' as file, round(jd,2) as jd, 15.0+image_id%7 as mag, 0.01 as magerr from fx_images where image_id%7<>3 and image_id%11<>2")
def a07(spark, d):
    lines = sql(spark, d, "select concat('img', image_id, '.fits ', format_string('%.2f', jd), ' x r 30 1.1 5 22 0.01 18 1.2 ', case when image_id%7=3 then '99.9' else cast(15.0+image_id%7 as string) end, case when image_id%11=2 then '' else ' 0.01 t o ok' end) as value from fx_images")
    return tables.parse_results(lines).select("file", "jd", "mag", "magerr")


@query("a09_regions", "select 'circle('||printf('%.7f',radeg)||','||printf('%.7f',decdeg)||','||printf('%.3f',5.0)||'\") # color='||case when star_id%2=0 then 'red' else 'cyan' end as value from fx_stars")
def a09(spark, d):
    rows = view(spark, d, "fx_stars").withColumns({"color": tables.class_color(F.when(F.col("star_id") % 2 == 0, "OT").otherwise("none")), "radius": F.lit(5.0)})
    return tables.to_regions(rows)


@query("a13_incremental", "select image_id, strftime(make_timestamp(cast(round((jd-2440587.5)*86400*1000000) as bigint)),'%y%m') as ym from fx_images where image_id%3=0 or image_id%3=1")
def a13(spark, d):
    new = sql(spark, d, "select image_id, jd, concat(image_id, '.fits') as fitsfile, case when image_id%3=1 then 20 else 5 end as mtime from fx_images")
    old = sql(spark, d, "select concat(image_id, '.fits') as fitsfile, 10 as mtime from fx_images where image_id%3>0")
    return archive.incremental(new, old).select("image_id", "ym")


@query("a13_quality_gate", "select image_id from fx_images where astsigma<0.225")
def a13_gate(spark, d):
    return archive.quality_gate(view(spark, d, "fx_images"), 0.225).select("image_id")


@query("a14_split_rejected", "select image_id, image_id%6<=4 and image_id%4<2 as accepted from fx_images")
def a14(spark, d):
    rows = sql(spark, d, "select image_id, image_id%6*1.0e0 as wssrndf, 0.1e0*(image_id%4) as dmagzero from fx_images")
    good, bad = tables.split_rejected(rows, 4.0)
    return good.select("image_id", F.lit(True).alias("accepted")).union(bad.select("image_id", F.lit(False)))


@query("a16_select_vars", "select star_id, round(radeg,9) as radeg, round(sloan_r,6) as sloan_r from fx_stars")
def a16(spark, d):
    return tables.select_vars(view(spark, d, "fx_stars"), "star_id,radeg,sloan_r").select("star_id", F.round("radeg", 9).alias("radeg"), F.round("sloan_r", 6).alias("sloan_r"))


@query("a04_magnitude_splits", "select floor(sloan_r/8)*8+8 as mag_split, count(*) as n from fx_stars where sloan_r<=70.003 group by 1")
def a04(spark, d):
    """The split column and limit of scan_splits as a query; tests hold writing and pruning."""
    edges = [8.0 * n for n in range(1, 16)]
    split = F.ceil((F.floor(F.col("sloan_r") / 8) + 1)) * 8
    rows = view(spark, d, "fx_stars").withColumn("mag_split", split.cast("double"))
    keep = [e for n, e in enumerate(edges) if n == 0 or edges[n - 1] < 70.003]
    return rows.where(F.col("mag_split").isin(keep) & (F.col("sloan_r") <= 70.003)).groupBy("mag_split").agg(F.count(F.lit(1)).alias("n"))



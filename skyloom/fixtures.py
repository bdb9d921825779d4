"""Fixture views over the driver's tables: astronomy-like inputs derived from them by arithmetic.

The SQL is one text for Spark and for the DuckDB oracle, but for the time arithmetic of ``fx_trails``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS = {
    "fx_images": """
    select s_suppkey as image_id, s_suppkey % 4 as field_id, 2460310.5e0 + s_suppkey*0.02e0 as jd, 30.0e0+10.0e0*(s_suppkey%4) as exptime,
      1000.0e0 as ctrx, 1000.0e0 as ctry, 2002 as imgaxis1, 2003 as imgaxis2, 2.0e0+0.1e0*(s_suppkey%9) as fwhm, 5.0e0+(s_suppkey%11) as bgsigma,
      case s_nationkey%4 when 0 then 'Sloan_g' when 1 then 'Sloan_r' when 2 then 'r' else 'R' end as filter, 22.0e0+0.05e0*(s_suppkey%7) as true_zp,
      case when s_suppkey%10=9 then null else 22.0e0+0.05e0*(s_suppkey%7) end as magzero, 0.2e0+0.01e0*(s_suppkey%5) as astsigma, 4.0e0 as astvar,
      150.0e0 + case when s_suppkey%25=24 then 0.05e0*s_suppkey else 0.001e0*(s_suppkey%13) end as ctrra, 20.0e0+0.001e0*(s_suppkey%17) as ctrdec, 0.42e0 as field from supplier
    """,
    "fx_stars0": """
    select p_partkey as star_id, ((p_partkey*7919)%20011)*0.1e0 as cat_x, ((p_partkey*104729)%20021)*0.1e0 as cat_y,
      12.0e0+(p_retailprice-900.0e0)/12.5e0 as sloan_r, 0.2e0+p_size/50.0e0 as g_r, (p_partkey%37)/60.0e0 as r_i, (p_partkey%23)/80.0e0 as i_z, (p_partkey%19)/30.0e0 as z_j,
      ((p_partkey%41)-20)*1.0e-6 as pmra, ((p_partkey%43)-21)*1.0e-6 as pmdec, (p_partkey%29)*1.0e0-2.0e0 as parallax from part
    """,
    "fx_stars": """
    select star_id, cat_x, cat_y, 150.0e0+degrees(atan2(-xi, cos(radians(20.0e0))-eta*sin(radians(20.0e0)))) as radeg,
      degrees(asin((sin(radians(20.0e0))+eta*cos(radians(20.0e0)))/sqrt(1.0e0+xi*xi+eta*eta))) as decdeg, sloan_r+g_r as sloan_g, sloan_r, sloan_r-r_i as sloan_i, sloan_r-r_i-i_z as sloan_z, sloan_r-r_i-i_z-z_j as j, pmra, pmdec, parallax
      from (select *, radians((cat_x-1000.0e0)*0.0003e0) as xi, radians((cat_y-1000.0e0)*0.0003e0) as eta from fx_stars0) q
    """,
    "fx_det": """
    select l_suppkey as image_id, (l_orderkey*10+l_linenumber)*100000+l_partkey as number, l_partkey as true_star_id,
      cat_x+(((l_orderkey*31+l_linenumber)%401)-200)/100.0e0 as x_image, cat_y+(((l_orderkey*17+l_linenumber*5)%401)-200)/100.0e0 as y_image,
      sloan_r-22.0e0-0.05e0*(l_suppkey%7)+0.02e0*(cat_x-1000.0e0)/1024.0e0-0.03e0*(cat_y-1000.0e0)/1024.0e0+(l_discount-0.05e0)*0.4e0 - case when (l_orderkey*13+l_linenumber)%97=0 then 1.5e0 else 0.0e0 end as mag_auto,
      0.005e0+l_tax*0.25e0 as magerr_auto, 0.01e0+l_discount*0.5e0 as errx2_image, 0.01e0+l_tax*0.5e0 as erry2_image, 2.0e0+l_quantity/50.0e0 as fwhm_image, l_linenumber%3 as ellipticity, case when l_returnflag='R' then 1 else 0 end as flags
      from (select l_suppkey,l_orderkey,l_linenumber,l_partkey,min(l_quantity) as l_quantity,min(l_discount) as l_discount,min(l_tax) as l_tax,min(l_returnflag) as l_returnflag from lineitem group by 1,2,3,4) li join fx_stars on l_partkey=star_id
    """,
    "fx_cat2": """
    select c_custkey as usno_id, ((c_custkey*6151)%20011)*0.1e0 as x, ((c_custkey*50331653)%20021)*0.1e0 as y, 10.0e0+(c_acctbal+1000.0e0)/1000.0e0 as r1 from customer
    """,
    "fx_pixels": """
    select s_suppkey as image_id, n_nationkey as y, px as x, 100.0e0+((s_suppkey*7+n_nationkey*13+px*29)%53)*0.5e0+0.2e0*n_nationkey as value, 1.0e0-0.01e0*(px%10) as weight
      from supplier cross join nation cross join (select distinct p_size as px from part) p
    """,
    "fx_trails": """
    select user_id as trail_id, event_id as number, 2460310.5e0+timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)/86400000000.0e0 as jd, value, event_type from events
    """,
}
#: The duckdb form of the views that differ.
DUCKDB = {
    "fx_trails": """
    select user_id as trail_id, event_id as number, 2460310.5e0+date_diff('microsecond', timestamp '2024-01-01 00:00:00', ts)/86400000000.0e0 as jd, value, event_type from events
    """,
}
#: Spark's hints of views. A star table of a few MB of Parquet holds a million rows: Spark would take it for small, and the
#: driver would build a broadcast of hundreds of MB. So it is dealt by star like the detections, of which it has few.
HINTS = {"fx_det": "shuffle_hash(fx_stars)"}


def _needed(sql: str) -> list[str]:
    """Views that ``sql`` names, with those that they name, in the order of VIEWS."""
    found, todo = set(), [sql]
    while todo:
        for name in set(re.findall(r"\bfx_\w+", todo.pop())) & set(VIEWS) - found:
            found.add(name)
            todo.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def _hinted(name: str) -> str:
    text = VIEWS[name]
    return text.replace("select ", f"select /*+ {HINTS[name]} */ ", 1) if name in HINTS else text


def view(spark: SparkSession, sf_dir: str, name: str, deal: dict[str, str] = {}) -> DataFrame:
    """One fixture view as a DataFrame over the tables in ``sf_dir``."""
    return sql(spark, sf_dir, f"select * from {name}", deal)


#: All columns of fx_det: the least of a text is aggregated by sorting. Where rows are dealt by star first, one shuffle and
#: one sort serve both halves of the aggregate and the join.
BY_STAR = {"lineitem": "l_partkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str, deal: dict[str, str] = {}) -> DataFrame:
    """A Spark SQL select over tables and fixture views; the tables in ``deal`` are dealt by a column when they are read."""
    ctes = [f"{name} as ({_hinted(name)})" for name in _needed(text)]
    body = " ".join([text, *ctes])
    tables = {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", body)}
    tables |= {t: tables[t].repartition(c) for t, c in deal.items()}
    for t in tables:
        named = re.compile(rf"\b(from|join) {t}\b")
        ctes = [named.sub(rf"\1 {{{t}}}", c) for c in ctes]
        text = named.sub(rf"\1 {{{t}}}", text)
    return spark.sql(("with " + ", ".join(ctes) + " " if ctes else "") + text, **tables)


def oracle(text: str) -> str:
    """DuckDB SQL with the fixture views that ``text`` names put before its own ``with``, if any."""
    ctes = [f"{name} as ({DUCKDB.get(name, VIEWS[name])})" for name in _needed(text)]
    text = text.strip()
    if not ctes:
        return text
    if text.startswith("with recursive "):
        return "with recursive " + ", ".join(ctes) + ", " + text[15:]
    return "with " + ", ".join(ctes) + (", " + text[5:] if text.startswith("with ") else " " + text)

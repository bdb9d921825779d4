"""Readers and writers of detection tables, catalogues, result logs, models and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of the meta keys of an image that become typed columns; all are also in ``extra``.
NUMBERS = ("ctrra", "ctrdec", "ctrx", "ctry", "imgaxis1", "imgaxis2", "fwhm", "bgsigma", "jd", "exptime", "airmass", "latitude", "longitud", "altitude", "limflx3", "objra", "objdec", "astsigma", "astvar", "magzero", "dmagzero")
TEXTS = ("field", "fitsfile", "filter", "obsid", "response", "phfilter", "phschema")


def read_ecsv(spark: SparkSession, path: str, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(det, images) of ECSV files: a YAML header in ``#`` lines, a line of column names, delimited rows.

    ``columns`` names the wanted columns and their Spark types (files may order columns differently or lack some:
    null). Each file is one record, split by native functions; ``meta`` scalars become ``extra``, a map, and the typed
    columns NUMBERS and TEXTS of images; of a key that occurs more than once (COMMENT, HISTORY) the last value counts.
    A file without a line of names, or one that cannot be read (an I/O error, a broken gzip), is skipped: see
    ``skipped_files``. Cells may be quoted, with delimiters and line ends inside and quotes doubled; a line whose quotes
    do not close is a row as it stands. Rows with empty fields give nulls. Keys: ``file`` in both tables. Files are the unit of work; an image's table is small.
    """
    files = _lines(_texts(spark, path), F.regexp_extract_all(F.regexp_replace("value", "\r", ""), F.lit(_RECORD), F.lit(0)))
    files = files.withColumns({"head": F.filter("lines", lambda x: x.startswith("#")), "body": F.filter("lines", lambda x: ~x.startswith("#"))}).where(F.size("body") > 0)
    comma = F.exists("head", lambda x: x.rlike("delimiter: *','|delimiter: *,"))
    plain = lambda x: F.replace(F.regexp_replace(F.trim(x), '^"|"$', ""), F.lit('""'), F.lit('"'))
    files = files.withColumn("names", F.transform(_cells(F.element_at("body", 1), comma), lambda x: F.lower(plain(x))))
    # Meta entries are ``#   KEY: value`` or ``# - !!omap`` items ``#   - {KEY: value}``; column entries have braces of their own.
    entry = r"^#\s+(?:- )?\{?([A-Za-z][\w-]*): (.*?)\}?$"
    start = F.array_position(F.transform("head", lambda x: x.rlike(r"^#\s*meta:")), True)
    meta = F.when(start > 0, F.slice("head", (start + 1).cast("int"), F.size("head"))).otherwise(F.array().cast("array<string>"))
    pairs = F.filter(F.transform(meta, lambda x: F.struct(F.lower(F.regexp_extract(x, entry, 1)).alias("k"), F.regexp_replace(F.regexp_extract(x, entry, 2), "^['\"]|['\"]$", "").alias("v"))), lambda p: p["k"] != "")
    files = files.withColumn("extra", _last_entries(pairs))
    images = files.select("file", *[F.try_element_at("extra", F.lit(c)).try_cast("double").alias(c) for c in NUMBERS], *[F.try_element_at("extra", F.lit(c)).alias(c) for c in TEXTS], "extra")
    rows = files.select("file", "names", comma.alias("_c"), F.posexplode(F.expr("slice(body, 2, size(body))")).alias("row", "line"))
    rows = rows.withColumn("cells", F.transform(_cells(F.col("line"), F.col("_c")), plain))
    det = rows.select("file", "row", *[F.get("cells", F.array_position("names", c).cast("int") - 1).try_cast(t).alias(c) if t != "string" else F.get("cells", F.array_position("names", c).cast("int") - 1).alias(c) for c, t in columns.items()])
    return det, images


def _lines(texts: DataFrame, lines: Column) -> DataFrame:
    """(file, lines): the lines of each text that are not blank. A generator gives them, through which neither filters
    nor later columns are merged: a text is split once, not once for each of them."""
    return texts.select(F.input_file_name().alias("file"), F.explode(F.array(F.filter(lines, lambda x: F.trim(x) != ""))).alias("lines"))


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """Files as one text each; those that cannot be read give no row."""
    return spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").text(path, wholetext=True)


def skipped_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, reason) of the files under ``path`` that ``read_ecsv`` leaves out: ``unreadable``, or ``no
    names`` where there is text but no line of column names. The listing is compared with what was read, so each file
    that gives no table is named, whatever its fault; files of no bytes hold nothing and are not listed."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    named = F.exists(F.split(F.regexp_replace("value", "\r", ""), "\n"), lambda x: (F.trim(x) != "") & ~F.trim(x).startswith("#"))
    read = _texts(spark, path).select(F.col("_metadata.file_path").alias("file"), named.alias("named"))
    found = listed.join(read, "file", "left")
    reason = F.when(F.col("named").isNotNull(), "no names").otherwise("unreadable")
    return found.where("named is null or not named").select("file", "bytes", reason.alias("reason"))


#: A comment line; a row up to the first line end outside of quotes; else a line.
_RECORD = r'(?m)^#[^\n]*|(?=[^\n])[^"\n]*+(?:"[^"]*+"[^"\n]*+)*+(?=\n|\z)|[^\n]+'


def _cells(line: Column, comma: Column) -> Column:
    """Cells of a line, at commas or blanks outside of quotes."""
    quoted = '"[^"]*+(?:""[^"]*+)*+"'
    by_comma = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",( *{quoted} *|[^,]*)"), F.lit(1))
    return F.when(comma, by_comma).otherwise(F.regexp_extract_all(line, F.lit(f'({quoted}|[^ "]+)'), F.lit(1)))


def _last_entries(pairs: Column) -> Column:
    """A map of (k, v) entries; of equal keys the last one counts."""
    later = lambda p, i: F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"])
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~later(p, i)))


def read_ascii_head(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Catalogues whose ``# n NAME ..`` lines give the columns of blank-separated rows; missing names are null."""
    files = _lines(spark.read.text(path, wholetext=True), F.split(F.regexp_replace("value", "\r", ""), "\n"))
    head = r"^#\s*(\d+)\s+(\S+)"
    names = F.transform(F.filter("lines", lambda x: x.rlike(head)), lambda x: F.struct(F.lower(F.regexp_extract(x, head, 2)).alias("k"), F.regexp_extract(x, head, 1).cast("int").alias("v")))
    rows = files.withColumn("names", _last_entries(names)).select("file", "names", F.posexplode(F.filter("lines", lambda x: ~x.startswith("#"))).alias("row", "line"))
    rows = rows.withColumn("cells", F.split(F.trim("line"), r"\s+"))
    return rows.select("file", "row", *[F.get("cells", F.try_element_at("names", F.lit(c)) - 1).try_cast(t).alias(c) for c, t in columns.items()])


#: The 44 integer columns of the catalogue's text form, and the scales that give degrees, mag, arcsec.
REFCAT_COLUMNS = (
    "ra dec plx dplx pmra dpmra pmdec dpmdec gaia dgaia bp dbp rp drp teff agaia dupvar ag rp1 r1 r10 "
    "g dg gchi gcontrib r dr rchi rcontrib i di ichi icontrib z dz zchi zcontrib nstat j dj h dh k dk"
).split()
REFCAT_SCALES = {"ra": 1e-8, "dec": 1e-8, "plx": 1e-2, "dplx": 1e-2, "pmra": 1e-5 / 3600, "dpmra": 1e-5 / 3600, "pmdec": 1e-5 / 3600, "dpmdec": 1e-5 / 3600, "rp1": 0.1, "r1": 0.1, "r10": 0.1, "gchi": 1e-2, "rchi": 1e-2, "ichi": 1e-2, "zchi": 1e-2}
_MILLI = {"gaia", "dgaia", "bp", "dbp", "rp", "drp", "agaia", "ag", "g", "dg", "r", "dr", "i", "di", "z", "dz", "j", "dj", "h", "dh", "k", "dk"}


def scale_refcat(df: DataFrame) -> DataFrame:
    """Integers to degrees, degrees/yr, mas (parallax), arcsec and magnitudes, under the names of the normalised catalogue."""
    names = {"ra": "radeg", "dec": "decdeg", "g": "sloan_g", "r": "sloan_r", "i": "sloan_i", "z": "sloan_z", "plx": "parallax"}
    scale = lambda c: REFCAT_SCALES.get(c, 1e-3 if c in _MILLI else None)
    return df.select(*[(F.col(c) * scale(c) if scale(c) else F.col(c)).alias(names.get(c, c)) for c in df.columns])


_REFCAT_LINE = r"^\s*-?\d+(\s*,\s*-?\d+){43}\s*$"


def read_refcat_csv(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue's CSV files of 44 integers a row. Other rows are left out; ``bad_refcat_rows`` has them."""
    cells = F.split("value", ",")
    rows = spark.read.text(path).where(F.col("value").rlike(_REFCAT_LINE))
    return scale_refcat(rows.select(*[F.trim(cells[n]).cast("long").alias(c) for n, c in enumerate(REFCAT_COLUMNS)]))


def bad_refcat_rows(spark: SparkSession, path: str) -> DataFrame:
    """(line) of the rows, blank ones aside, that ``read_refcat_csv`` leaves out."""
    bad = ~F.col("value").rlike(_REFCAT_LINE) & (F.trim("value") != "")
    return spark.read.text(path).where(bad).select(F.col("value").alias("line"))


def write_splits(stars: DataFrame, path: str, edges: list[float], mag: str = "sloan_r", tile: Column | None = None) -> None:
    """Writes stars partitioned by mag_split (upper edge of the magnitude) and, within, sorted by magnitude, so
    that a limit prunes directories and row groups. ``tile`` clusters a split's files on the sky."""
    split = F.lit(None).cast("double")
    for e in reversed(edges):
        split = F.when(F.col(mag) <= e, float(e)).otherwise(split)
    rows = stars.withColumn("mag_split", split).where("mag_split is not null")
    order = [tile, F.col(mag)] if tile is not None else [F.col(mag)]
    rows.repartition("mag_split", F.pmod(F.xxhash64(tile if tile is not None else F.col(mag)), F.lit(16))).sortWithinPartitions("mag_split", *order).write.partitionBy("mag_split").mode("overwrite").parquet(path)


def scan_splits(spark: SparkSession, path: str, mlim: float, mag: str = "sloan_r") -> DataFrame:
    """Stars to a magnitude limit; splits wholly fainter than the limit are not read."""
    df = spark.read.parquet(path)
    edges = sorted(float(r[0]) for r in df.select("mag_split").distinct().collect())  # one per split
    keep = [e for n, e in enumerate(edges) if n == 0 or edges[n - 1] < mlim]
    return df.where(F.col("mag_split").isin(keep)).where(F.col(mag) <= mlim)


def normalize_catalog(df: DataFrame, mapping: dict[str, str], mas: tuple[str, ...] = ("pmra", "pmdec")) -> DataFrame:
    """Columns renamed by ``{new: old}``, those in ``mas`` from mas/yr to degrees/yr; missing ones are 0."""
    out = []
    for new, old in mapping.items():
        c = F.col(old).cast("double") if old in df.columns else F.lit(0.0)
        out.append(((c / 3.6e6) if new in mas else c).alias(new))
    return df.select(*out)


def with_motion(df: DataFrame) -> DataFrame:
    """Adds pmra, pmdec and parallax of 0 where the catalogue has none."""
    return df.withColumns({c: F.lit(0.0) for c in ("pmra", "pmdec", "parallax") if c not in df.columns})


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A saved catalogue, CSV (by its extension) or Parquet."""
    df = spark.read.csv(path, header=True, inferSchema=True) if path.rstrip("/").endswith((".csv", ".csv.gz")) else spark.read.parquet(path)
    return with_motion(df)


def parse_results(lines: DataFrame) -> DataFrame:
    """(file, jd, mag, magerr) of log lines (column ``value``) of at least 13 fields; mag is field 12, the error
    field 13; rows without numbers or with mag > 90 go."""
    f = F.split(F.trim("value"), r"\s+")
    rows = lines.where(F.size(f) >= 13).select(F.get(f, F.lit(0)).alias("file"), F.get(f, F.lit(1)).try_cast("double").alias("jd"), F.get(f, F.lit(11)).try_cast("double").alias("mag"), F.get(f, F.lit(12)).try_cast("double").alias("magerr"))
    return rows.where("mag is not null and magerr is not null and mag <= 90")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return parse_results(spark.read.text(path))


def require_all(images: DataFrame, results: DataFrame) -> DataFrame:
    """``images`` as they are; raises where one has no result of the same base name."""
    base = lambda c: F.element_at(F.split(F.col(c), "/"), -1)
    missing = images.join(results.select(base("file").alias("_b")), base("fitsfile") == F.col("_b"), "left_anti").limit(5).collect()
    if missing:
        raise ValueError(f"images without a result: {[r.fitsfile for r in missing]}")
    return images


REGION_HEADER = "# Region file format: DS9 version 4.1\nfk5"


def to_regions(df: DataFrame, color: str = "color", radius: str = "radius", ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """(value) one region line per row: circle, radius in arcsec, colour; ``write_regions`` puts the header first."""
    return df.select(F.format_string('circle(%.7f,%.7f,%.3f") # color=%s', F.col(ra), F.col(dec), F.col(radius), F.col(color)).alias("value"))


def write_regions(df: DataFrame, path: str, **options) -> None:
    lines = to_regions(df, **options)
    head = df.sparkSession.createDataFrame([(REGION_HEADER,)], "value string")
    head.union(lines).coalesce(1).write.mode("overwrite").text(path)


def class_color(kind: Column) -> Column:
    """Colour of an object class or type."""
    colors = {"uncatalogued": "red", "poor_fwhm": "brown", "brighter": "yellow", "fainter": "blue", "normal": "green", "OT": "red", "MP": "yellow", "MV": "orange"}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in colors.items() for x in p]), kind), F.lit("cyan"))


def to_report_json(classified: DataFrame, images: DataFrame, fields: tuple[str, ...] = ("number", "x_image", "y_image", "mag_calib", "type")) -> DataFrame:
    """A10: (image_id, report): one JSON text per image: objects in order of number, counts by type, metadata."""
    objects = classified.where("type is not null").groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("objects"))  # an image's objects
    counts = classified.where("type is not null").groupBy("image_id", "type").agg(F.count(F.lit(1)).alias("n")).groupBy("image_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "n")))).alias("summary"))
    meta = images.select("image_id", F.struct("filter", "jd", "exptime").alias("metadata"))
    rows = meta.join(objects, "image_id", "left").join(counts, "image_id", "left")
    empty = F.coalesce("objects", F.array().cast(objects.schema["objects"].dataType))
    return rows.select("image_id", F.to_json(F.struct("metadata", "summary", empty.alias("objects"))).alias("report"))


def format_results(df: DataFrame, kind: str = "photometry") -> DataFrame:
    """(image_id, value): the result line of an image's target: ``photometry`` (file, jd, filter, exptime, zp, mag,
    error, status) or ``astrometry`` (file, jd, position, errors, fwhm, snr, mag, status). A row without a number has
    99.999 and status ``not_found``."""
    found = F.col("number").isNotNull()
    num = lambda c, fmt, none: F.when(found & F.col(c).isNotNull(), F.format_string(fmt, F.col(c))).otherwise(F.lit(none))
    status = F.when(found, "ok").otherwise("not_found")
    file, jd = F.col("fitsfile"), F.format_string("%.6f", F.col("jd"))
    if kind == "photometry":
        parts = [file, jd, F.col("filter"), F.format_string("%.1f", F.col("exptime")), F.format_string("%.3f", F.coalesce("magzero", F.lit(99.999))), num("mag_calib", "%.3f", "99.999"), num("magerr_calib", "%.3f", "99.999"), status]
    elif kind == "astrometry":
        parts = [file, jd, num("alpha_j2000", "%.7f", "-"), num("delta_j2000", "%.7f", "-"), num("ra_err", "%.4f", "-"), num("dec_err", "%.4f", "-"), num("fwhm_arcsec", "%.3f", "-"), num("snr", "%.1f", "-"), num("mag_calib", "%.3f", "99.999"), status]
    else:
        raise ValueError(f"unknown kind {kind}")
    return df.select("image_id", F.concat_ws(" ", *parts).alias("value"))


def save_model(model: DataFrame, path: str) -> None:
    """A model table (term, value, err, fixed)."""
    model.select("term", "value", "err", "fixed").coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    """A saved model; terms of error 0 load as fixed."""
    return spark.read.parquet(path).withColumn("fixed", F.coalesce(F.col("err") == 0, F.lit(False)))


def response_string(model: DataFrame, images: DataFrame) -> DataFrame:
    """(image_id, response): ``FILTER=..,SCHEMA=..,term=value,..``: global terms and the image's own without its
    suffix; those of other images are left out. ``images`` have phfilter and phschema."""
    own = F.regexp_extract("term", r":(\d+)$", 1)
    rows = model.select(F.regexp_replace("term", r":\d+$", "").alias("t"), F.when(own != "", own.cast("long")).alias("n"), "value")
    ids = images.select("image_id", "phfilter", "phschema")
    every = F.concat(F.col("t"), F.lit("="), F.col("value").cast("string"))
    glob = rows.where("n is null").agg(F.sort_array(F.collect_list(F.struct("t", every.alias("s")))).alias("g"))  # a model's terms
    mine = rows.where("n is not null").groupBy(F.col("n").alias("image_id")).agg(F.sort_array(F.collect_list(F.struct("t", every.alias("s")))).alias("m"))
    out = ids.join(F.broadcast(glob)).join(mine, "image_id", "left")  # one row
    parts = F.concat(F.col("g"), F.coalesce("m", F.array().cast("array<struct<t:string,s:string>>")))
    return out.select("image_id", F.concat_ws(",", F.concat(F.lit("FILTER="), F.col("phfilter")), F.concat(F.lit("SCHEMA="), F.col("phschema")), F.array_join(F.transform(F.sort_array(parts), lambda p: p["s"]), ",")).alias("response"))


def split_rejected(images: DataFrame, reject: float, max_error: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected are those of wssrndf > reject or a zeropoint error of at least max_error, or
    without either number."""
    good = F.coalesce((F.col("wssrndf") <= reject) & (F.col("dmagzero") < max_error), F.lit(False))
    return images.where(good), images.where(~good)


def diagnostics(pairs: DataFrame, model: dict[str, float]) -> DataFrame:
    """Catalogue and modelled magnitudes, colours, positions, residuals and errors of matched pairs."""
    from ..functions.response import eval_response

    out = eval_response(pairs, model, out="mag_model")
    names = ["image_id", "number", "star_id", "cat_mag", "mag_model", "dy", *[c for c in ("color1", "color2", "color3", "color4") if c in pairs.columns], "coord_x", "coord_y", "x_image", "y_image", "cat_x", "cat_y", "dist", "image_dxy"]
    return out.withColumn("residual", F.col("cat_mag") - F.col("mag_model")).select(*names, "residual")


def select_vars(stars: DataFrame, names: str) -> DataFrame:
    """Columns by a comma-separated list, ``ALL``, or ``ATLAS`` (the bands with the synthetic cyan and orange);
    an unknown name raises."""
    from ..functions.bands import atlas_co

    if names.upper() == "ALL":
        return stars
    if names.upper() == "ATLAS":
        return atlas_co(stars).select("radeg", "decdeg", "sloan_g", "sloan_r", "sloan_i", "sloan_z", "j", "cyan", "orange")
    wanted = [n.strip().lower() for n in names.split(",")]
    unknown = [n for n in wanted if n not in stars.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    return stars.select(*wanted)

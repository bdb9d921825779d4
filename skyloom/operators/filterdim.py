"""Filters of catalogues and colour schemas as dimension tables, and the choice of an image's filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (catalogue, position, filter, effective wavelength in angstrom, system, error column).
FILTERS = [
    ("panstarrs", 0, "g", 4810, "AB", "dg"),
    ("panstarrs", 1, "r", 6170, "AB", "dr"),
    ("panstarrs", 2, "i", 7520, "AB", "di"),
    ("panstarrs", 3, "z", 8660, "AB", "dz"),
    ("panstarrs", 4, "y", 9620, "AB", "dy"),
    ("gaia", 0, "G", 5890, "AB", "G_err"),
    ("gaia", 1, "BP", 5050, "AB", "BP_err"),
    ("gaia", 2, "RP", 7730, "AB", "RP_err"),
    ("gaia", 3, "Johnson_B", 4353, "Vega", None),
    ("gaia", 4, "Johnson_V", 5477, "Vega", None),
    ("gaia", 5, "Johnson_R", 6349, "Vega", None),
    ("gaia", 6, "Johnson_I", 8797, "Vega", None),
    ("atlas", 0, "Sloan_g", 4810, "AB", None),
    ("atlas", 1, "Sloan_r", 6170, "AB", None),
    ("atlas", 2, "Sloan_i", 7520, "AB", None),
    ("atlas", 3, "Sloan_z", 8660, "AB", None),
    ("atlas", 4, "J", 12000, "AB", None),
    ("atlas", 5, "J_Vega", 12000, "Vega", None),
    ("atlas", 6, "Johnson_B", 4353, "Vega", None),
    ("atlas", 7, "Johnson_V", 5477, "Vega", None),
    ("atlas", 8, "Johnson_R", 6349, "Vega", None),
    ("atlas", 9, "Johnson_I", 8797, "Vega", None),
    ("usno", 0, "B1", 4500, "AB", "e_B1mag"),
    ("usno", 1, "R1", 6400, "AB", "e_R1mag"),
    ("usno", 2, "B2", 4500, "AB", "e_B2mag"),
    ("usno", 3, "R2", 6400, "AB", "e_R2mag"),
    ("usno", 4, "I", 8100, "AB", "e_Imag"),
    ("sdss", 0, "Sloan_u", 3551, "AB", "Sloan_u_err"),
    ("sdss", 1, "Sloan_g", 4686, "AB", "Sloan_g_err"),
    ("sdss", 2, "Sloan_r", 6166, "AB", "Sloan_r_err"),
    ("sdss", 3, "Sloan_i", 7480, "AB", "Sloan_i_err"),
    ("sdss", 4, "Sloan_z", 8932, "AB", "Sloan_z_err"),
]
#: Colour schemas in order of preference.
SCHEMAS = {
    "JohnsonU": ["Johnson_U", "Johnson_B", "Johnson_V", "Johnson_R", "Johnson_I"],
    "JohnsonJ": ["Johnson_B", "Johnson_V", "Johnson_R", "Johnson_I", "J_Vega"],
    "SloanU": ["Sloan_u", "Sloan_g", "Sloan_r", "Sloan_i", "Sloan_z"],
    "SloanJ": ["Sloan_g", "Sloan_r", "Sloan_i", "Sloan_z", "J"],
    "Gaia": ["BP", "G", "RP", "BP", "RP"],
    "GaiaJ": ["Johnson_B", "Johnson_V", "Johnson_R", "Johnson_I", "Johnson_I"],
    "PS": ["g", "r", "i", "z", "y"],
    "USNO": ["B2", "R2", "I", "R1", "B1"],
}
#: Wavelengths of filter names in image headers.
WAVELENGTHS = {
    "U": 3600, "B": 4353, "V": 5477, "R": 6349, "I": 8797, "g": 4810, "r": 6170, "i": 7520, "z": 8660, "y": 9620,
    "G": 5890, "BP": 5050, "RP": 7730, "Sloan_g": 4810, "Sloan_r": 6170, "Sloan_i": 7520, "Sloan_z": 8660,
    "Johnson_U": 3600, "Johnson_B": 4353, "Johnson_V": 5477, "Johnson_R": 6349, "Johnson_I": 8797, "N": 6000,
}


def filters_dim(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """(catalog, position, filter_name, wavelength, system, error_column)."""
    df = spark.createDataFrame(FILTERS, "catalog string, position int, filter_name string, wavelength int, system string, error_column string")
    return df if catalog is None else df.where(F.col("catalog") == catalog)


def schemas_dim(spark: SparkSession) -> DataFrame:
    """(schema_name, schema_position, schema)."""
    return spark.createDataFrame([(name, n, bands) for n, (name, bands) in enumerate(SCHEMAS.items())], "schema_name string, schema_position int, schema array<string>")


def closest_filter(images: DataFrame, filters: DataFrame, wavelength: str = "target_wl") -> DataFrame:
    """Adds closest, the catalogue filter nearest in wavelength (ties: first of the catalogue); null without a
    wavelength. ``filters`` are one catalogue's (a handful): they go along as an array, no join is needed."""
    rows = filters.select(F.struct("position", "filter_name", "wavelength").alias("f")).agg(F.sort_array(F.collect_list("f")).alias("_filters"))
    near = F.array_min(F.transform("_filters", lambda f: F.struct(F.abs(f["wavelength"] - F.col(wavelength)).alias("d"), f["position"].alias("p"), f["filter_name"].alias("n"))))
    return images.join(F.broadcast(rows)).withColumn("closest", F.when(F.col(wavelength).isNotNull(), near["n"])).drop("_filters")  # one row


def base_filter(images: DataFrame, filters: DataFrame) -> DataFrame:
    """Adds base_filter: the header's where the catalogue has it, else the nearest by the wavelength of the name,
    else the first of the catalogue. A missing name is Sloan_r."""
    spark = images.sparkSession
    known = spark.createDataFrame(list(WAVELENGTHS.items()), "_name string, target_wl int")
    rows = images.withColumn("_name", F.coalesce("filter", F.lit("Sloan_r"))).join(known, "_name", "left")
    rows = closest_filter(rows, filters)
    exact = filters.select(F.col("filter_name").alias("_name"), F.col("filter_name").alias("_exact"))
    first = filters.agg(F.min_by("filter_name", "position").alias("_first"))
    rows = rows.join(exact, "_name", "left").join(F.broadcast(first))  # one row
    return rows.withColumn("base_filter", F.coalesce("_exact", "closest", "_first")).drop("_name", "_exact", "_first", "closest", "target_wl")


def compatible_schema(filters: DataFrame, schemas: DataFrame, base: DataFrame) -> DataFrame:
    """(base_filter, schema_name): the first schema that holds the base filter and only filters of the
    catalogue; null without one. ``base(base_filter)``."""
    have = filters.agg(F.collect_set("filter_name").alias("_have"))
    fit = schemas.join(F.broadcast(have)).where(F.size(F.array_except("schema", "_have")) == 0)  # one row
    names = base.select("base_filter").distinct()
    long = fit.select("schema_name", "schema_position", F.explode(F.array_distinct("schema")).alias("base_filter"))
    best = long.groupBy("base_filter").agg(F.min_by("schema_name", "schema_position").alias("schema_name"))
    return names.join(best, "base_filter", "left")


def assign_filters(images: DataFrame, filters: DataFrame, schemas: DataFrame, override: str | None = None) -> DataFrame:
    """Adds phfilter, phsystem, phschema. ``override`` names a schema whose second band is then the filter;
    the XC and SC terms need that too."""
    rows = base_filter(images, filters)
    rows = rows.join(compatible_schema(filters, schemas, rows), "base_filter", "left")
    system = filters.select(F.col("filter_name").alias("phfilter"), F.col("system").alias("phsystem"))
    if override is not None:
        one = schemas.where(F.col("schema_name") == override).select(F.col("schema_name").alias("phschema"), F.element_at("schema", 2).alias("phfilter"))
        rows = rows.drop("schema_name", "base_filter").join(F.broadcast(one))  # one row
    else:
        rows = rows.withColumnRenamed("schema_name", "phschema").withColumnRenamed("base_filter", "phfilter")
    return rows.join(system, "phfilter", "left")

"""Catalogues stored by place: 1 x 1 degree tiles as partitions, which scans of fields prune by, and fine cells as
buckets, on which match jobs join without moving the catalogue."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.astrom import separation
from ..operators.filters import rect_condition, tile_of
from ..operators.match import finite

#: (field, tile) rows up to which they are broadcast: 1 M are about 50 MB.
BROADCAST_TILES = 1_000_000
#: Parts that a tile's stars are dealt to when a catalogue is written; crowded tiles get several files.
PARTS = 16
_BAND = 1 << 32


def write_tiled(stars: DataFrame, path: str, ra: str = "radeg", dec: str = "decdeg") -> None:
    """A catalogue partitioned by its 1 x 1 degree ``tile``, sorted by dec within files. Stars without a finite
    position are left out, as no field holds them; a column ``tile`` of the stars is replaced."""
    rows = stars.where(finite(F.col(ra)) & finite(F.col(dec))).withColumn("tile", tile_of(F.pmod(F.col(ra), F.lit(360.0)), F.col(dec)))
    parts = rows.repartition("tile", F.pmod(F.xxhash64(ra, dec), F.lit(PARTS)))
    parts.sortWithinPartitions("tile", dec).write.partitionBy("tile").mode("overwrite").parquet(path)


def _reach(r: Column, dec: Column) -> Column:
    """Half the width in RA (degrees) of a circle: 180 over a pole. A little more than exact, for the rounding."""
    over = F.abs(dec) + r >= 90
    return F.when(over, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.sin(F.radians(F.least(r, F.lit(90.0)))) / F.greatest(F.cos(F.radians(dec)), F.lit(1e-12)), F.lit(1.0)))) * 1.000001 + 1e-9)


def covering_tiles(fields: DataFrame, shape: str = "circle") -> DataFrame:
    """(field_id, tile): every tile in which a star of a field can lie; ``fields`` as for ``tiles_for``. Unlike the
    marked tiles of C16 these leave no tile out that a field touches between corners, so a scan of them is complete."""
    if shape == "circle":
        r = F.col("da")
    else:
        side = F.sqrt(F.pow(F.sin(F.radians("da")), F.lit(2)) + F.pow(F.sin(F.radians("dd")), F.lit(2)))
        r = F.degrees(F.asin(F.least(side, F.lit(1.0))))
    rows = fields.select("field_id", F.pmod("ra0", F.lit(360.0)).alias("_a"), F.col("dec0").alias("_d"), (r * 1.000001 + 2e-8).alias("_r")).where("_a is not null and _d is not null and _r is not null")
    band = lambda c: F.least(F.greatest(F.floor(c) + 90, F.lit(0)), F.lit(179))
    rows = rows.withColumn("_j", F.explode(F.sequence(band(F.col("_d") - F.col("_r")), band(F.col("_d") + F.col("_r")))))
    half = _reach(F.col("_r"), F.col("_d"))
    lo, hi = F.floor(F.col("_a") - half), F.floor(F.col("_a") + half + 1e-8)
    columns = F.when(hi - lo >= 359, F.sequence(F.lit(0), F.lit(359)).cast("array<bigint>")).otherwise(F.transform(F.sequence(lo, hi), lambda k: F.pmod(k, F.lit(360))))
    rows = rows.withColumn("_i", F.explode(F.array_distinct(columns)))
    return rows.select("field_id", (F.col("_i") + 360 * F.col("_j")).cast("int").alias("tile"))


def scan_fields(spark: SparkSession, path: str, fields: DataFrame, shape: str = "circle", ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """(field_id, stars) of a tiled catalogue within fields ``fields(field_id, ra0, dec0, da, dd)``: rectangles
    (C01) or circles of radius da (C02). Only the tiles that a field can touch are read: their numbers, at most 64,800,
    are in the scan's partition filter. A star in several fields comes with each of them."""
    tiles = covering_tiles(fields, shape)
    numbers = sorted(row.tile for row in tiles.select("tile").distinct().collect())  # at most one for each tile of the sky
    shapes = tiles.join(fields.select("field_id", *[F.col(c).cast("double").alias(f"_{c}") for c in ("ra0", "dec0", "da", *(["dd"] if shape != "circle" else []))]), "field_id")
    stars = spark.read.parquet(path).withColumn("tile", F.col("tile").cast("int"))
    hint = F.broadcast if shapes.count() <= BROADCAST_TILES else (lambda df: df)
    found = stars.where(F.col("tile").isin(numbers)).join(hint(shapes), "tile")
    if shape == "circle":
        inside = separation(F.col(ra), F.col(dec), F.col("_ra0"), F.col("_dec0")) <= F.col("_da")
    else:
        inside = rect_condition(F.col(ra), F.col(dec), F.col("_ra0"), F.col("_dec0"), F.col("_da"), F.col("_dd"))
    return found.where(inside).drop(*[c for c in shapes.columns if c.startswith("_")])


class CellIndex:
    """A catalogue as a table bucketed by sky cells of ``size`` degrees, written once and matched many times."""

    def __init__(self, spark: SparkSession, table: str, size: float, ra: str = "radeg", dec: str = "decdeg"):
        self.spark, self.table, self.size, self.ra, self.dec = spark, table, float(size), ra, dec

    def _columns(self, band: Column) -> Column:
        """Number of cells of a band: as many as are at least ``size`` wide at its edge nearer to a pole."""
        edge = F.least(F.greatest(F.abs(band * self.size), F.abs((band + 1) * self.size)), F.lit(90.0))
        return F.greatest(F.floor(360.0 * F.cos(F.radians(edge)) / self.size), F.lit(1))

    def _cell(self, band: Column, column: Column) -> Column:
        return (band * F.lit(_BAND) + column).cast("long")

    def write(self, stars: DataFrame, path: str, buckets: int = 64) -> CellIndex:
        """Stars without a finite position are left out: they match nothing. Adds the column sky_cell."""
        rows = stars.where(finite(F.col(self.ra)) & finite(F.col(self.dec)))
        band = F.floor(F.col(self.dec) / self.size)
        n = self._columns(band)
        column = F.least(F.floor(F.pmod(F.col(self.ra), F.lit(360.0)) / 360.0 * n), n - 1)
        rows = rows.withColumn("sky_cell", self._cell(band, column)).repartition(buckets, "sky_cell")
        rows.write.format("parquet").option("path", path).bucketBy(buckets, "sky_cell").sortBy("sky_cell").saveAsTable(self.table)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def drop(self) -> None:
        """Forgets the table; its files stay."""
        self.spark.sql(f"drop table if exists {self.table}")

    def post(self, det: DataFrame, r: float, ra: str = "alpha_j2000", dec: str = "delta_j2000") -> DataFrame:
        """``det`` once for each cell that the circle of r degrees about it touches (sky_cell): one for most, if cells
        are much larger than r."""
        at = F.pmod(F.col(ra), F.lit(360.0))
        rows = det.where(finite(F.col(ra)) & finite(F.col(dec)))
        lo, hi = (F.floor((F.col(dec) + s * r * 1.000001) / self.size) for s in (-1, 1))
        least, most = math.floor(-90 / self.size), math.floor(90 / self.size)  # the pole itself may begin a band
        rows = rows.withColumn("_b", F.explode(F.sequence(F.greatest(lo, F.lit(least)), F.least(hi, F.lit(most)))))
        n, half = self._columns(F.col("_b")), _reach(F.lit(float(r)), F.col(dec))
        first, last = F.floor((at - half) / 360.0 * n), F.floor((at + half) / 360.0 * n)
        # The last column of a band also holds what rounding would put past it.
        around = F.when(last - first + 1 >= n, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array_distinct(F.transform(F.sequence(first, last), lambda k: F.pmod(k, n))))
        return rows.withColumn("_c", F.explode(around)).withColumn("sky_cell", self._cell(F.col("_b"), F.col("_c"))).drop("_b", "_c")

    def match(self, det: DataFrame, r: float, ra: str = "alpha_j2000", dec: str = "delta_j2000") -> DataFrame:
        """Every pair of a detection and a star at most r degrees apart, with dist (degrees). Only the detections
        are exchanged; the catalogue is read bucket by bucket where it lies. Columns of the two sides must differ."""
        dist = separation(F.col(ra), F.col(dec), F.col(self.ra), F.col(self.dec))
        joined = self.post(det, r, ra, dec).join(self.read().hint("merge"), "sky_cell")
        return joined.withColumn("dist", dist).where(F.col("dist") <= r).drop("sky_cell")

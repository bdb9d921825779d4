"""The archive of images and their detections: batches are appended, of an image the newest version is read.

Both tables are partitioned by the image's month and the batch. A batch's detections are written before its images, and
only batches whose images are there count, so a job that fails on the way leaves nothing that a reader sees and may be
run again. Nothing is rewritten when an image is redone: the reader leaves superseded copies out, ``compact_catalog``
deletes them.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import delete, discard, staged

#: Superseded copies up to which their list is broadcast: 1 M are about 50 MB.
BROADCAST_COPIES = 1_000_000


def month_of(jd: Column) -> Column:
    """YYMM of a JD (UTC)."""
    return F.date_format(F.timestamp_seconds((jd - 2440587.5) * 86400), "yyMM")


def write_catalog(det: DataFrame, images: DataFrame, path: str, version: str = "mtime") -> str:
    """Appends images and their detections as two Parquet tables under ``path`` and returns the batch's name.

    An image that the archive has already is replaced if the new ``version`` (a number or time; 0 without that column,
    or where it is null) is at least that of the copy, so the same batch again changes nothing and a stale one does not
    come through. Of rows of one image in a batch the greatest version counts. Images and detections of null image_id
    are not archived; ``ym``, ``batch`` and ``archive_version`` are the archive's own columns. Detections are dealt by
    ranges of a month's images, taken from ``images`` alone, so that a task writes files of few months.
    """
    batch = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    own = ("ym", "batch", "archive_version")
    value = F.coalesce(F.col(version).cast("double"), F.lit(0.0)) if version in images.columns else F.lit(0.0)
    plain = images.drop(*[c for c in own if c != version])
    rows = plain.where("image_id is not null").withColumns({"archive_version": value, "ym": month_of(F.col("jd")), "batch": F.lit(batch)})
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    newest = rows.groupBy("image_id").agg(F.max_by(whole, F.struct("archive_version", F.xxhash64(whole))).alias("r")).select("r.*")
    n = int(det.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = newest.select(rows.columns).repartitionByRange(n, "ym", "image_id").withColumn("_range", F.spark_partition_id())
    newest = staged(ranged.coalesce(max(n // 16, 1)), "images")  # ranges are many for so small a table
    parts = det.drop(*own).join(newest.select("image_id", "ym", "batch", "_range"), "image_id").repartition("_range").drop("_range")
    parts.write.partitionBy("ym", "batch").mode("append").parquet(f"{path}/detections")
    newest.drop("_range").write.partitionBy("ym", "batch").mode("append").parquet(f"{path}/images")  # from here on the batch counts
    discard(newest)
    return batch


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(detections, images) in the newest versions, and (image_id, batch) of superseded copies, staged."""
    copies = spark.read.parquet(f"{path}/images").withColumns({c: F.col(c).cast("string") for c in ("ym", "batch")})
    newest = copies.groupBy("image_id").agg(F.max(F.struct("archive_version", "batch")).alias("m")).select("image_id", F.col("m.batch").alias("batch"))
    images = copies.join(newest, ["image_id", "batch"], "left_semi")
    det = spark.read.parquet(f"{path}/detections").withColumns({c: F.col(c).cast("string") for c in ("ym", "batch")})
    det = det.join(copies.select("batch").distinct(), "batch", "left_semi")
    old = staged(copies.select("image_id", "batch").join(newest, ["image_id", "batch"], "left_anti"), "superseded")
    n = old.count()
    if n:
        det = det.join(F.broadcast(old) if n <= BROADCAST_COPIES else old, ["image_id", "batch"], "left_anti")
    return det, images, old


def read_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(detections, images) of the archive, each image in its newest version: greatest version, then latest
    batch. The detections are not shuffled for it unless more than BROADCAST_COPIES copies are superseded: without any
    there is no join but that on the batches that count."""
    return _read(spark, path)[:2]


def compact_catalog(spark: SparkSession, path: str) -> list[str]:
    """Writes what is current of batches with superseded images as a new batch and deletes those batches, whose
    names it returns. Not while others read or write."""
    det, images, old = _read(spark, path)
    names = sorted(row.batch for row in old.select("batch").distinct().collect())  # batches, not images
    if not names:
        return []
    kept = images.where(F.col("batch").isin(names))
    if not kept.isEmpty():
        write_catalog(det.where(F.col("batch").isin(names)), kept, path, version="archive_version")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for table in ("images", "detections"):  # images first: a batch without them does not count
        for name in names:
            pattern = hadoop(f"{path}/{table}/ym=*/batch={name}")
            for found in pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []:
                delete(spark, found.getPath().toString())
    return names


def incremental(new_images: DataFrame, archive: DataFrame, key: str = "fitsfile", modified: str = "mtime") -> DataFrame:
    """Images that the archive lacks, or has from before the source's last change; adds ym."""
    old = archive.groupBy(key).agg(F.max(modified).alias("_old"))
    rows = new_images.join(old, key, "left").where(F.col("_old").isNull() | (F.col(modified) > F.col("_old"))).drop("_old")
    return rows.withColumn("ym", month_of(F.col("jd")))


def quality_gate(images: DataFrame, max_astsigma: float) -> DataFrame:
    """Images whose astsigma is below the limit."""
    return images.where(F.col("astsigma") < max_astsigma)

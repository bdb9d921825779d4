"""The archive: batches twice, redone images, stale and broken batches, compaction."""

from pyspark.sql import functions as F

from skyloom.sources import archive


def batch(spark, rows):
    """(image_id, mtime, jd, magnitude) as images and three detections of each."""
    images = spark.createDataFrame([(i, m, jd, f"im{i}") for i, m, jd, _ in rows], "image_id long, mtime long, jd double, fitsfile string")
    det = spark.createDataFrame([(i, n, mag, "own") for i, _, _, mag in rows for n in range(3)], "image_id long, number long, mag double, batch string")
    return det, images


def read(spark, path):
    det, images = archive.read_catalog(spark, path)
    found = {}
    for r in det.collect():
        found.setdefault(r.image_id, []).append((r.number, r.mag, r.ym))
    assert {r.image_id for r in images.collect()} == set(found) and images.count() == len(found)
    return {i: sorted(v) for i, v in found.items()}


def three(mag, ym):
    return [(n, mag, ym) for n in range(3)]


def test_images_are_there_once(spark, tmp_path):
    path = str(tmp_path / "a")
    first = batch(spark, [(1, 10, 2460310.5, 1.0), (2, 10, 2460310.5, 2.0), (3, None, 2460350.5, 3.0), (None, 10, 2460310.5, 9.0)])
    archive.write_catalog(*first, path)
    want = {1: three(1.0, "2401"), 2: three(2.0, "2401"), 3: three(3.0, "2402")}
    assert read(spark, path) == want
    archive.write_catalog(*first, path)  # a retried job
    assert read(spark, path) == want
    archive.write_catalog(*batch(spark, [(2, 11, 2460350.5, 2.5), (4, 1, 2460310.5, 4.0), (3, 5, 2460350.5, 3.5)]), path)
    want |= {2: three(2.5, "2402"), 4: three(4.0, "2401"), 3: three(3.5, "2402")}
    assert read(spark, path) == want
    archive.write_catalog(*batch(spark, [(2, 10, 2460310.5, 2.0), (1, 9, 2460310.5, 0.0)]), path)  # older sources
    assert read(spark, path) == want
    det, images = batch(spark, [(1, 20, 2460310.5, 7.0)])
    broken = det.withColumns({"ym": F.lit("2401"), "batch": F.lit("99990101")})  # a job that ended before its images
    broken.write.partitionBy("ym", "batch").mode("append").parquet(f"{path}/detections")
    assert read(spark, path) == want
    names = archive.compact_catalog(spark, path)
    assert len(names) == 3 and read(spark, path) == want and archive.compact_catalog(spark, path) == []
    left = {r.batch for r in spark.read.parquet(f"{path}/detections").select("batch").distinct().collect()}
    assert not left & set(names)


def test_two_versions_of_an_image_in_a_batch(spark, tmp_path):
    det, images = batch(spark, [(1, 10, 2460310.5, 1.0)])
    more = images.withColumns({"mtime": F.lit(12).cast("long"), "jd": F.lit(2460350.5)})
    archive.write_catalog(det, images.union(more).union(more), str(tmp_path))
    assert read(spark, str(tmp_path)) == {1: three(1.0, "2402")}


def test_redone_images(spark, tmp_path):
    det, images = batch(spark, [(1, 10, 2460310.5, 1.0), (2, 10, 2460310.5, 2.0)])
    archive.write_catalog(det, images, str(tmp_path))
    new = images.withColumn("mtime", F.when(F.col("image_id") == 2, 30).otherwise(10).cast("long"))
    assert [r.image_id for r in archive.incremental(new, archive.read_catalog(spark, str(tmp_path))[1]).collect()] == [2]


def test_reading_does_not_shuffle_detections(spark, tmp_path):
    det, images = batch(spark, [(1, 10, 2460310.5, 1.0), (2, 10, 2460310.5, 2.0)])
    for _ in range(2):
        archive.write_catalog(det, images, str(tmp_path))
    plan = archive.read_catalog(spark, str(tmp_path))[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_files_hold_ranges_of_images(spark, tmp_path):
    """tasks held scattered images of all months, and wrote a file for each month."""
    months = spark.range(1200).selectExpr("id as image_id", "10L as mtime", "2460310.5e0 + id as jd", "concat('im', id) as fitsfile")
    det = spark.range(6000).selectExpr("id % 1200 as image_id", "id as number", "1.0e0 as mag")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table were one task
    try:
        archive.write_catalog(det, months, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = spark.read.parquet(f"{tmp_path}/detections").selectExpr("_metadata.file_path as f", "image_id", "ym")
    files = found.select("f", "ym").distinct().collect()
    assert len({r.ym for r in files}) == 40 and len(files) <= 40 + 4
    assert found.count() == 6000 and "_range" not in archive.read_catalog(spark, str(tmp_path))[1].columns

"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest, so that each new batch meets it by a sort-merge join in
which the index is not shuffled. A batch is first reduced to one row per digest (map-side combine), then an anti-join
finds the digests the index lacks, and those are appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, delete, discard, shared_dir, staged, text_of


def normalised(text: Column) -> Column:
    """The text without its blanks (space, \\t, \\n, \\x0b, \\x0c, \\r)."""
    return F.translate(text, BLANKS, "")


class DigestIndex:
    """Index of the digests seen so far: ``digest binary, keep_id long, keep_chars long, batch string``, in ``buckets``
    buckets.

    ``path`` is the folder of the table; a folder that an earlier session wrote is opened again with its bucketing.
    Make ``buckets`` about the size of the final index over 128 MB; it is fixed for the life of the index. Each batch
    adds a file a bucket: ``compacted`` writes the index anew with one.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        if not spark.catalog.tableExists(self.table):
            spark.sql(
                f"create table {self.table} (digest binary, keep_id bigint, keep_chars bigint, batch string) using parquet "
                f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{path}'"
            )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, rows: DataFrame) -> None:
        (
            rows.repartition(self.buckets, "digest")
            .write.format("parquet").mode("append").option("path", self.path)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)

    def compacted(self, path: str, buckets: int | None = None) -> DigestIndex:
        """The same index in another folder, with one file a bucket."""
        index = DigestIndex(self.spark, path, buckets or self.buckets)
        index.append(self.read())
        return index

    def drop(self) -> None:
        """Delete the index and its entry in the catalogue."""
        self.spark.sql(f"drop table if exists {self.table}")
        delete(self.spark, self.path)

    def ingest(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batch: str | None = None) -> DataFrame:
        """Decide each row of ``docs`` and append its new digests to the index.

        Of equal texts, the one that an earlier batch has stays; else the row with the most code points, then the
        smallest id. Returns one row per input row: id, ``keep_id, group_size`` (rows of this batch with the text),
        ``kept, text_sha256``. ``batch`` names the batch; by default a fingerprint of its ids and texts does. The same
        batch again, after a crash at whatever point, gives the same answer and adds only what is missing.

        Nulls: a null text is empty, and empty texts are equal; a row without an id is kept only if no row of its text
        has an id. Repeated ids with one text: the id is kept on each such row. Other columns are ignored. An empty
        table gives no rows.
        """
        text = text_of(text_column)
        keyed = docs.select(
            F.col(id_column).cast("long").alias(id_column),
            F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
            F.length(text).cast("long").alias("chars"),
        )
        keyed = staged(keyed, "digests")
        if batch is None:
            row = F.xxhash64("digest", id_column, "chars")
            batch = "-".join(str(x or 0) for x in keyed.agg(F.count(F.lit(1)), F.bit_xor(row), F.sum(F.shiftright(row, 32))).first())
        # One row per digest before anything is joined, so a text that fills a third of the batch is one row here.
        first = F.struct((-F.col("chars")).alias("c"), F.col(id_column).isNull().alias("n"), F.col(id_column).alias("i"))
        new = (
            keyed.groupBy("digest")
            .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("first.i").alias("own_id"), (-F.col("first.c")).alias("own_chars"), "group_size")
        )
        new = staged(new, "batch")
        known = self.read()
        fresh = F.col("batch").isNull() | (F.col("batch") == batch)
        decided = staged(
            new.hint("merge").join(known, "digest", "left").select("digest", F.when(fresh, F.col("own_id")).otherwise(F.col("keep_id")).alias("keep_id"), fresh.alias("fresh"), "group_size"),
            "decided",
        )
        lacking = new.join(known.select("digest").hint("merge"), "digest", "left_anti")
        self.append(lacking.select("digest", F.col("own_id").alias("keep_id"), F.col("own_chars").alias("keep_chars"), F.lit(batch).alias("batch")))
        discard(new)
        # A hot digest is on the left side only; AQE splits its partition.
        return keyed.join(decided, "digest").select(
            id_column,
            "keep_id",
            "group_size",
            (F.col("fresh") & F.col(id_column).eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """``DigestIndex.ingest`` with an index of its own, deleted afterwards, where none is given."""
    if index is not None:
        return index.ingest(docs)
    spark = docs.sparkSession
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = DigestIndex(spark, f"{shared_dir(spark)}/digest-index-{uuid.uuid4().hex}", buckets)
    decided = index.ingest(docs)
    index.drop()
    return decided


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of exact dedup over all documents, with an index of its own."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
with d as (select doc_id, coalesce(text, '') as t from documents),
e as (select doc_id, length(t) as chars, sha256(translate(t, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), '')) as h from d),
g as (select h, arg_min(doc_id, (-chars, doc_id)) as keep_id, count(*) as group_size from e group by h)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, h as text_sha256 from e join g using (h)
"""

"""Exact token counts for every context limit, from the length histogram."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, text_of
from .tokens import Encoder, vocabulary


def lengths(docs: DataFrame, vocab: tuple[str, str | None] | None = None) -> DataFrame:
    """doc_id and n_tokens of each document; a null text has none."""
    vocab = vocab or vocabulary()

    def count(batches):
        encode = Encoder.get(*vocab)
        for batch in batches:
            sizes = [len(encode(text.as_py())) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(count, "doc_id long, n_tokens long")


def token_counts(docs: DataFrame, vocab: tuple[str, str | None] | None = None, block: int = 256) -> DataFrame:
    """One row per encoded length that occurs, with what a context limit of that length keeps.

    Returns: limit, n_docs (of just that length), docs_within (not cut), docs_cut, tokens_within (of documents not
    cut), truncated_tokens (kept when each document is cut to the limit), total_tokens, quantile (share of documents
    that are not cut, so the least limit with quantile >= q is the q-quantile of length), first_doc_id (smallest id of
    that length). For a limit between two rows, truncated tokens = tokens_within of the row below + limit * docs_cut
    of that row. Nulls: a null text has no tokens. Repeated rows count each. An empty table gives no rows.

    Documents are pre-aggregated by length before the one shuffle. The suffix sums go over blocks of ``block`` lengths
    first, then within the blocks, so no task sees all lengths.
    """
    hist = (
        lengths(docs, vocab)
        .groupBy(F.col("n_tokens").alias("limit"))
        .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc_id"))
        .withColumn("block", F.expr(f"limit div {block}"))
    )
    hist = staged(hist, "lengths")
    sums = [F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("limit")).alias("t")]
    blocks = hist.groupBy("block").agg(*sums)
    above = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # longest text / block rows
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t0"),
    )
    totals = hist.agg(F.sum("n_docs").alias("all_docs"), F.sum(F.col("n_docs") * F.col("limit")).alias("total_tokens"))
    upto = Window.partitionBy("block").orderBy("limit").rowsBetween(Window.unboundedPreceding, 0)
    out = hist.join(blocks, "block").join(F.broadcast(totals))  # one row
    out = out.withColumn("docs_within", F.col("d0") + F.sum("n_docs").over(upto)).withColumn(
        "tokens_within", F.col("t0") + F.sum(F.col("n_docs") * F.col("limit")).over(upto)
    )
    cut = F.col("all_docs") - F.col("docs_within")
    return out.select(
        "limit",
        "n_docs",
        "docs_within",
        cut.alias("docs_cut"),
        "tokens_within",
        (F.col("tokens_within") + F.col("limit") * cut).alias("truncated_tokens"),
        "total_tokens",
        (F.col("docs_within") / F.col("all_docs")).alias("quantile"),
        "first_doc_id",
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents for every context limit that is some length."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))

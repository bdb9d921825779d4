"""The corpus pipeline: quality filter, exact dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as Parquet and reads
it again as the next one's docs. All but the last return the columns of ``documents``. Each stage keeps rows of null
text (as empty texts) and rows of null id where its operator does not drop them by its decision. Decisions are of rows:
those of a null or repeated id each have a key of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import discard, staged
from skyloom.llm.decontaminate import contaminated
from skyloom.llm.exact_dedup import exact_dedup
from skyloom.llm.near_dedup import near_duplicates
from skyloom.llm.packing import pack
from skyloom.llm.quality import score_quality

#: Documents whose calibrated probability of good quality is under this go.
QUALITY = 0.5
#: Ids beyond which decisions are joined by shuffle: 4 M ids are about 64 MB as a broadcast table.
BROADCAST_IDS = 4_000_000


def _free(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it a name that ``df`` lacks."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a key of its own for each row, and that column's name.

    The key is the id where that names one row. Of the rows of a repeated id one keeps it; the others, and rows of null
    id, are staged and get new numbers beyond all ids, so that every row goes or stays by its own decision.
    """
    key = _free(docs, "row_key")
    docs = docs.withColumn(key, F.col("doc_id").cast("long"))
    ids = docs.select(key)
    counts = ids.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = staged(counts.where("n > 1").select(key), "repeated")
    n_repeated = repeated.count()
    low, high, nulls = ids.agg(F.min(key), F.max(key), F.count_if(F.col(key).isNull())).first()
    if not n_repeated and not nulls:
        return docs, key
    if high is not None and high >= 1 << 62 and low <= -(1 << 62):  # no room on either side of the ids
        return staged(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key
    repeated = F.broadcast(repeated) if n_repeated <= BROADCAST_IDS else repeated
    number = _free(docs, "row_number")
    odd = docs.where(F.col(key).isNull()).unionByName(docs.join(repeated, key, "left_semi"))
    odd = staged(odd.withColumn(number, F.monotonically_increasing_id()), "odd-ids")
    keeps = _free(odd, "keeps_id")
    first = odd.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col(number).alias("n"))).alias("m"))
    odd = odd.join(first.select(F.col("m.n").alias(number), F.lit(True).alias(keeps)), number, "left")
    new = F.lit(high + 1 if high is not None else 0) + F.col(number) if high is None or high < 1 << 62 else F.lit(low - 1) - F.col(number)
    odd = odd.withColumn(key, F.when(F.col(keeps), F.col(key)).otherwise(new)).drop(number, keeps)
    return docs.where(F.col(key).isNotNull()).join(repeated, key, "left_anti").unionByName(odd), key


def _texts(keyed: DataFrame, key: str) -> DataFrame:
    """What the operators read: each row's key as its doc_id, and its text."""
    return keyed.select(F.col(key).alias("doc_id"), "text")


def _without(keyed: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose keys are not in ``dropped(doc_id)``, without the key."""
    dropped = staged(dropped.select(F.col("doc_id").alias(key)).distinct(), "dropped")
    few = dropped.count() <= BROADCAST_IDS
    return keyed.join(F.broadcast(dropped) if few else dropped, key, "left_anti").drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier scores at QUALITY or more. A null or empty text is scored as one of no words; each row
    of a repeated or null id is scored by its own text; other columns, whatever their names, are kept as they are; an
    empty table stays empty."""
    keyed, key = _keyed(docs)
    scores = score_quality(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"), rows=_texts(keyed, key))
    return _without(keyed, key, scores.where(F.col("score") < QUALITY))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text (blanks aside): the longest, then that of smallest key. Null and empty texts are one text.
    Rows of a repeated or null id are rows of their own, so wholly repeated rows leave one; an empty table stays empty."""
    keyed, key = _keyed(docs)
    return _without(keyed, key, exact_dedup(_texts(keyed, key)).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates, that of smallest key. Texts without words are all kept; rows of a
    repeated or null id are rows of their own; an empty table stays empty."""
    keyed, key = _keyed(docs)
    return _without(keyed, key, near_duplicates(_texts(keyed, key), k=5, percent=80).where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no passage with the benchmark. Null and empty texts share none; each row of a repeated or null
    id is decided by its own text; an empty table, or an empty benchmark, drops nothing."""
    keyed, key = _keyed(docs)
    return _without(keyed, key, contaminated(_texts(keyed, key), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their places in sequences of 1024 tokens; see ``pack`` for nulls, repeats and ties."""
    return pack(docs, limit=1024)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontaminate), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table is deleted when the next one is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*last)
        last = [docs]
    return docs


#: A trained classifier and a tokenizer decide, which SQL can't express; tests hold run() against a brute-force version.
ORACLE_SQL = None

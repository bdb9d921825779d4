"""Near-duplicate detection by a signature-coordinate inverted join.

Each distinct shingle set has a MinHash signature; the set is posted under each (coordinate, value) pair. Two sets of
the wanted similarity agree in at least ``least_matches`` coordinates but for a chance of ``miss``, so they share a
pair within any ``coordinates - least_matches + 1`` pairs of each: pairs are ordered by how many sets carry them, the
rarest such prefix is posted, and the long lists of the rest are skipped. Pairs of sets that meet are kept if they
agree in enough coordinates, and confirmed on their full shingle sets.

Within a list only links matter, not all pairs: every member meets the list's hub (the member whose values are most
widely shared), collisions are counted, links are confirmed and contracted to components. A group of near copies so
costs one pair per member. Links between members other than the hub come from a last step: the sets of lists that
still hold several components are joined on the rarest of their shingles, with the bounds that a common shingle's
place in both orders sets on the overlap. Classes of both lengths are part of that join's key, so that sets which share
a long passage, but differ too much for a link, do not meet.
"""

from __future__ import annotations

from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Steps, discard, mix, runs, shingles, staged, text_of, words
from .components import connected_components

#: Ids beyond which candidates are joined by shuffle: 4 M ids are about 64 MB as a broadcast table.
BROADCAST_IDS = 4_000_000
#: Members of a hub that are confirmed in one run; the hub's text travels once for each run.
RUN_MEMBERS = 64
#: Ratio of neighbouring length classes of the last join.
CLASS_RATIO = 1.05


def least_matches(coordinates: int, similarity: float, miss: float) -> int:
    """Largest t for which fewer than t of the coordinates agree with a chance of at most ``miss``."""
    below = 0.0
    for t in range(coordinates):
        below += comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if below > miss:
            return max(1, t)
    return coordinates


def signatures(docs: DataFrame, k: int, coordinates: int, seed: int = 5) -> DataFrame:
    """doc_id, n_shingles, digest (128 bits of the shingle set; null without words), sig (array of coordinates)."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**63, coordinates, dtype=U64) * U64(2) + U64(1)
    b = rng.integers(0, 2**64, coordinates, dtype=U64)

    def sign(batches):
        for batch in batches:
            n = batch.num_rows
            sizes, digest = np.zeros(n, np.int64), np.zeros((n, 2), U64)
            sig = np.zeros((n, coordinates), np.uint32)
            for first, _, data, bounds in Steps(batch.column(1)):
                word, doc, _, _ = words(data, bounds)
                owner, value = shingles(word, doc, k)
                start, length = runs(owner)
                if not len(start):
                    continue
                at = owner[start] + first
                sizes[at] = length
                for j, salt in enumerate((U64(0x2545F4914F6CDD1D), U64(0x9FB21C651E98DF25))):
                    digest[at, j] = np.add.reduceat(mix(value ^ salt), start)
                for j in range(coordinates):
                    sig[at, j] = np.minimum.reduceat(((value * a[j] + b[j]) >> U64(32)).astype(np.uint32), start)
            none = sizes == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.array([None if e else d.tobytes() for e, d in zip(none, digest)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * coordinates), pa.array(sig.view(np.int32).ravel()), mask=pa.array(none)),
                ],
                ["doc_id", "n_shingles", "digest", "sig"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, sig array<int>")


def similar(hub: np.ndarray, owner: np.ndarray, value: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Which of ``n`` documents have a shingle set (``owner``, ``value``) that is similar enough to the sorted ``hub``."""
    size = np.bincount(owner, minlength=n)
    at = np.searchsorted(hub, value)
    at[at == len(hub)] = 0
    inter = np.bincount(owner[hub[at] == value] if len(hub) else owner[:0], minlength=n)
    return 100 * inter >= percent * (size + len(hub) - inter)


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, coordinates: int = 32, miss: float = 1e-7, seed: int = 5
) -> DataFrame:
    """Components of documents whose sets of ``k``-word shingles have ``100 * intersection >= percent * union``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a text of fewer than ``k`` words has its whole sequence
    as its one shingle; one without words is linked with nothing. Returns per row: doc_id, n_shingles, component_id
    (smallest doc_id reachable), kept (doc_id = component_id). Nulls: a null text has no words; a row of null id is
    kept, linked with nothing, its component null. Repeated rows of one id are each returned, with one component.
    Other columns are ignored. An empty table gives no rows.
    """
    need = least_matches(coordinates, percent / 100, miss)
    signed = staged(signatures(docs, k, coordinates, seed), "signatures")
    linked = signed.where("doc_id is not null and n_shingles > 0")
    # One row per distinct set, combined before the exchange, so that a text that fills a third of the rows is one row.
    reps = staged(linked.groupBy("digest").agg(F.min(F.struct("doc_id", "sig")).alias("m")).select("digest", F.col("m.doc_id").alias("rep"), F.col("m.sig").alias("sig")), "reps")
    members = staged(linked.select("doc_id", "n_shingles", "digest").join(reps.select("digest", "rep"), "digest").drop("digest"), "members")
    sets = reps.groupBy("rep").agg(F.first("sig").alias("sig"))  # of a repeated id with several texts any one

    posted = staged(_posted(sets, coordinates, need), "postings")
    hubs = posted.groupBy("tok").agg(F.max(F.struct("central", (-F.col("rep")).alias("r"))).alias("h"), F.count(F.lit(1)).alias("n"))
    hubs = hubs.where("n > 1").select("tok", (-F.col("h.r")).alias("hub"))
    star = posted.join(hubs, "tok").where("rep <> hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    tried = staged(_agreeing(star, sets, need), "star-pairs")
    links = staged(_confirmed(tried, docs, k, percent), "star-links")
    labels = connected_components(links)

    more = staged(_across(posted, labels, docs, k, percent).join(tried, ["a", "b"], "left_anti"), "cross-pairs")
    found = staged(_confirmed(more, docs, k, percent), "cross-links")
    discard(reps, posted, tried, more, labels)
    labels = connected_components(links.union(found))
    discard(links, found)

    joined = members.join(labels, members.rep == labels.id, "left")
    found = joined.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = signed.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _posted(reps: DataFrame, coordinates: int, need: int) -> DataFrame:
    """tok, rep, central: the prefix of each signature, rarest first, without pairs that only one set carries."""
    value = F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)
    toks = reps.select("rep", F.posexplode("sig").alias("p", "v")).select("rep", F.shiftleft(F.col("p").cast("long"), 32).bitwiseOR(value).alias("tok"))
    shared = toks.groupBy("tok").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = toks.join(shared, "tok").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "tok"))).alias("t"), F.sum("n").alias("central"))
    # The pairs that no other set carries are the rarest and fill the first places of the prefix.
    places = F.size("t") - F.lit(need - 1)
    prefix = own.where(places > 0).select("rep", "central", F.explode(F.slice("t", F.lit(1), places)).alias("t"))
    return prefix.select(F.col("t.tok").alias("tok"), "rep", "central")


def _agreeing(pairs: DataFrame, reps: DataFrame, need: int) -> DataFrame:
    """The pairs that agree in at least ``need`` coordinates."""
    one, two = reps.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), reps.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    equal = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    return pairs.join(one, "a").join(two, "b").where(equal >= need).select("a", "b")


def _texts(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """``ids(doc_id, ...)``, one row per id, with the id's text (of a repeated id with several texts each of them)."""
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.join(F.broadcast(ids) if few else ids, "doc_id")


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough.

    Of a pair, the id that is in more pairs is its hub. A hub's pairs are split into runs of about RUN_MEMBERS; a run
    is sorted, the hub's text first and then its members', and read as a stream: so a text travels once for each
    pair that it is a member in and once for each run that it is the hub of, and no task holds a group.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    ids = staged(ids, "candidates")
    texts = staged(_texts(ids.select(F.col("id").alias("doc_id")), docs).select("doc_id", "text").distinct(), "candidate-texts")
    one, two = ids.select(F.col("id").alias("a"), F.col("n").alias("na")), ids.select(F.col("id").alias("b"), F.col("n").alias("nb"))
    first = F.col("na") >= F.col("nb")
    of = pairs.join(one, "a").join(two, "b").select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("doc_id"), F.greatest("na", "nb").alias("n"))
    of = of.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / RUN_MEMBERS)))
    both = of.select("hub", "run", "doc_id", F.lit(1).alias("kind")).union(of.select("hub", "run", F.col("hub").alias("doc_id"), F.lit(0).alias("kind")).distinct())
    both = both.join(texts, "doc_id").repartition("hub", "run").sortWithinPartitions("hub", "run", "kind")

    def confirm(batches):
        run, hub = None, []
        for batch in batches:
            hubs, order, ids, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            keep = np.zeros(len(ids), bool)
            for at, end, data, bounds in Steps(batch.column(4)):
                word, doc, _, _ = words(data, bounds)
                owner, value = shingles(word, doc, k)
                cut = np.searchsorted(owner, np.arange(end - at + 1))
                key = np.stack((hubs[at:end], order[at:end], kinds[at:end]))
                for lo in np.flatnonzero(np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(0)))).tolist():
                    hi = lo + int(np.argmax(np.append((key[:, lo:] != key[:, lo : lo + 1]).any(0), True)))
                    if run != tuple(key[:2, lo]):
                        run, hub = tuple(key[:2, lo]), []
                    if not key[2, lo]:
                        hub += [value[cut[i] : cut[i + 1]].copy() for i in range(lo, hi)]
                        continue
                    mine = slice(cut[lo], cut[hi])
                    for own in hub:
                        keep[at + lo : at + hi] |= similar(own, owner[mine] - lo, value[mine], hi - lo, percent)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(hubs, ids)[keep]), pa.array(np.maximum(hubs, ids)[keep])], ["a", "b"])

    found = both.select("hub", "run", "doc_id", "kind", "text").mapInArrow(confirm, "a long, b long").distinct()
    found = staged(found, "confirmed")
    discard(ids, texts)
    return found


def _across(posted: DataFrame, labels: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs in different components so far that may be similar enough, of the sets in lists that hold several.

    Sets of the wanted similarity share a shingle within the first n - ceil(percent n / 100) + 1 of each in any common
    order; the order is by how many of these sets have the shingle, rarest first. Shingles of one set alone come first
    and are not posted. Where the first common shingle has p and q shingles before it, the overlap is at most
    min(n - p, m - q).
    """
    known = posted.join(labels, posted.rep == labels.id, "left").select("tok", "rep", F.coalesce("component", "rep").alias("c"))
    mixed = known.groupBy("tok").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("tok")
    open_ = staged(known.join(mixed, "tok").select("rep", "c").distinct(), "open")
    texts = _texts(open_.withColumnRenamed("rep", "doc_id"), docs).withColumnRenamed("doc_id", "rep")

    def sets(batches):
        for batch in batches:
            ids, labels_ = (batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1))
            for first, _, data, bounds in Steps(batch.column(2)):
                word, doc, _, _ = words(data, bounds)
                owner, value = shingles(word, doc, k)
                start, size = runs(owner)
                own = owner[start] + first
                lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate((start, [len(value)]))), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(labels_[own]), pa.array(size), lists.cast(pa.list_(pa.int64()))], ["rep", "c", "n", "s"])

    rows = texts.select("rep", "c", "text").mapInArrow(sets, "rep long, c long, n long, s array<long>").dropDuplicates(["rep"])
    rows = staged(rows.select("rep", "c", "n", F.explode("s").alias("s")), "open-sets")
    common = rows.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    ordered = rows.join(common, "s").groupBy("rep", "c", "n").agg(F.sort_array(F.collect_list(F.struct("f", "s"))).alias("t"))  # a text's length
    alone = F.col("n") - F.size("t")
    posts = ordered.withColumn("alone", alone).select("rep", "c", "n", "alone", F.posexplode("t").alias("j", "t"))
    place = F.col("alone") + F.col("j")
    posts = posts.select(F.col("t.s").alias("s"), "rep", "c", "n", place.alias("p"))
    # The overlap x = n - p allows partners of up to ``most`` shingles; a pair meets where the shorter one's posts for
    # the classes of the longer one's lengths meet those of the longer one for the classes of the shorter one's.
    n, least = F.col("n"), F.ceil(F.col("n") * percent / 100)
    most = F.floor(F.least(((100 + percent) * (n - F.col("p")) - percent * n) / percent, 100 * n / percent))
    cls = lambda x: F.floor(F.log(x) / log(CLASS_RATIO))
    short = posts.withColumn("most", most).where(F.col("most") >= n).withColumns({"cs": cls(n), "cl": F.explode(F.sequence(cls(n), cls(F.col("most"))))})
    long = posts.withColumn("most", F.least(most, n)).where(F.col("most") >= least).withColumns({"cl": cls(n), "cs": F.explode(F.sequence(cls(least), cls(F.col("most"))))})
    one, two = (x.select("s", "cs", "cl", *[F.col(y).alias(y + e) for y in ("rep", "c", "n", "p")]) for x, e in ((short, "a"), (long, "b")))
    overlap = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    may = (F.col("na") <= F.col("nb")) & ((100 + percent) * overlap >= percent * (F.col("na") + F.col("nb")))
    pairs = one.join(two, ["s", "cs", "cl"]).where((F.col("repa") != F.col("repb")) & (F.col("ca") != F.col("cb")) & may)
    pairs = staged(pairs.select(F.least("repa", "repb").alias("a"), F.greatest("repa", "repb").alias("b")).distinct(), "across")
    discard(rows, open_)
    return pairs


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 85 % of their 3-word shingles in common."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, percent=85)


SQL = """
with recursive w as (select doc_id, list_filter(regexp_split_to_array(lower_az, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az from documents)),
s as materialized (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g from w),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as i from s x join s y using (g) where x.doc_id <> y.doc_id group by 1, 2),
e as materialized (select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * i >= 85 * (x.n + y.n - i)),
r as (select doc_id, doc_id as c from w union select e.b, r.c from r join e on r.doc_id = e.a)
select w.doc_id, coalesce(n.n, 0) as n_shingles, min(r.c) as component_id, w.doc_id = min(r.c) as kept
from w left join n using (doc_id) join r on r.doc_id = w.doc_id group by w.doc_id, n.n
"""

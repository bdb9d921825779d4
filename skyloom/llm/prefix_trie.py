"""Prefix trie of conversations, from the longest common prefixes of sorted neighbours.

Conversations are sequences of turn digests, sorted by range over the cluster. Within a unit of sorted rows, edges join
neighbours and carry the length of their common prefix; they are taken in descending depth. The components that are
left at a depth are that depth's nodes, and where an edge merges components a node branches. Components are runs of
rows, so the first row of the run stands for it, and all merges of a depth are one step over arrays.

The first and the last row of a unit may share prefixes with other units. Their nodes stay open: the unit contracts to
these two rows, with what the finished subtrees under each open node add to it. Contracted rows of all units are sorted
and merged in the same way, until one unit is left whose nodes all close. So no prefix, however common, gathers its
members in one task: each unit hands on a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

#: Turns that one row holds; longer conversations go on in further rows, which are done first.
SEGMENT = 4096
#: Rows and entries of a unit.
UNIT_ROWS, UNIT_ENTRIES = 1 << 16, 1 << 22
#: Ids in one piece of a list of ends.
PIECE = 1000
#: Open nodes up to which they are broadcast: 1 M are about 40 MB.
BROADCAST_NODES = 1_000_000
NOTHING = hashlib.sha256(b"").hexdigest()
NONE = np.iinfo(np.int64).max
_KINDS = {
    "kind": pa.int32(), "conv_id": pa.int64(), "depth": pa.int64(), "parent": pa.int64(), "n": pa.int64(), "c": pa.int64(), "l": pa.int64(), "s": pa.int64(), "ends": pa.string(), "up": pa.binary(), "key": pa.binary(),
    "prefix": pa.binary(), "seq": pa.binary(), "sizes": pa.list_(pa.int64()), **{f"e_{x}": pa.list_(pa.int64()) for x in ("depth", "n", "mn", "c", "l", "s")}, "ord": pa.list_(pa.int64()), "ids": pa.string(),
}
_SPARK = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
_OUT = ", ".join(f"{name} {_SPARK[kind]}" for name, kind in _KINDS.items())
_NODE, _OPEN, _PIECE = 0, 1, 2


# --- numbering -------------------------------------------------------------------------------------------------------


def numbered(rows: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with pos, a row's place (from 0) among those of its ``key`` (a long, not null) in ``order``; staged.

    Rows are dealt by ranges of key and order, so a key of any size spreads over tasks. A task numbers the runs of its
    own rows; what a key's rows in earlier tasks add is one number for each task, from a row of each."""
    ranged = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    at = rows.columns.index(key)
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("pos", T.LongType())])

    def place(batches):
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(at).to_numpy()
            index = np.arange(len(k))
            new = np.concatenate(([last is None or k[0] != last], k[1:] != k[:-1]))
            pos = index - np.maximum.accumulate(np.where(new, index, 0))
            if not new[0]:
                pos[: int(np.argmax(new)) if new.any() else len(k)] += n
            last, n = k[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(k), part, np.int32)), pa.array(pos)], [*batch.schema.names, "_part", "pos"])

    table = staged(ranged.mapInArrow(place, schema), name)
    edges = table.groupBy("_part").agg(F.min(key).alias("lo"), F.max(F.struct(key, "pos")).alias("hi"))
    carried, run, n = [], None, 0
    for row in sorted(edges.collect(), key=lambda r: r._part):  # one row a task
        before = n if row.lo == run else 0
        if before:
            carried.append((row._part, row.lo, before))
        run, n = row.hi[key], row.hi.pos + 1 + (before if row.hi[key] == row.lo else 0)
    out = table
    if carried:
        more = rows.sparkSession.createDataFrame(carried, f"_part int, {key} long, _more long")
        out = table.join(F.broadcast(more), ["_part", key], "left").withColumn("pos", F.col("pos") + F.coalesce("_more", F.lit(0)))
    out = out.select(*rows.columns, "pos")
    out._staged = table._staged
    return out


# --- one unit --------------------------------------------------------------------------------------------------------


class _Unit:
    """Sorted rows as arrays: sequences, text sizes and what is known at each depth (entries)."""

    def __init__(self, table: pa.Table, first: bool, segment: int):
        col = lambda name: table.column(name).combine_chunks()
        self.prefix, self.seq = col("prefix").to_pylist(), col("seq").to_pylist()
        self.len = np.array([len(s) // 16 for s in self.seq], np.int64)
        self.at = np.cumsum(self.len) - self.len
        self.sizes = col("sizes").flatten().to_numpy(zero_copy_only=False)
        self.lcp = self._lcp()
        self.segment, self.paths = segment, {}
        rows = np.arange(len(self.seq))
        if first:
            self.ids = col("conv_id").to_numpy(zero_copy_only=False)
            graft = np.flatnonzero(col("graft").to_numpy(zero_copy_only=False))
            zero, g = np.zeros(len(rows), np.int64), lambda c: col(c).to_numpy(zero_copy_only=False)[graft].astype(np.int64)
            none = np.zeros(len(graft), np.int64)
            parts = [(rows, self.len, zero + 1, self.ids, zero, zero, zero), (graft, self.len[graft], none, none + NONE, g("g_c"), g("g_l"), g("g_s"))]
            self.entry = [np.concatenate(x) for x in zip(*parts)]
        else:
            self.ids = None
            count = col("e_depth").value_lengths().to_numpy(zero_copy_only=False)
            self.entry = [np.repeat(rows, count), *[col(f"e_{x}").flatten().to_numpy(zero_copy_only=False) for x in ("depth", "n", "mn", "c", "l", "s")]]
        order = np.argsort(self.entry[1], kind="stable")
        self.entry = [x[order] for x in self.entry]

    def _lcp(self) -> np.ndarray:
        """Depth of the edge between each row and the one before; -1 for the first and between different prefixes."""
        n = len(self.seq)
        out = np.full(n, -1, np.int64)
        if n < 2:
            return out
        turns = np.frombuffer(b"".join(self.seq), np.uint64).reshape(-1, 2)
        both = np.minimum(self.len[1:], self.len[:-1])
        edge = np.repeat(np.arange(n - 1), both)
        k = np.arange(len(edge)) - np.repeat(np.cumsum(both) - both, both)
        other = np.flatnonzero((turns[self.at[edge] + k] != turns[self.at[edge + 1] + k]).any(axis=1))[::-1]
        both[edge[other]] = k[other]  # the least one is written last
        same = np.array([a == b for a, b in zip(self.prefix[1:], self.prefix[:-1])])
        out[1:] = np.where(same, both, -1)
        return out

    def key(self, row: int, depth: int) -> bytes:
        """Key of the node of that depth on the row's path."""
        if row not in self.paths:
            h = hashlib.md5(self.prefix[row])
            self.paths[row] = [h.digest()]
            for d in range(self.len[row]):
                h.update(self.seq[row][16 * d : 16 * d + 16])
                self.paths[row].append(h.copy().digest())
        return self.paths[row][depth]


def _contract(unit: _Unit, final: bool, order: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Closed nodes, contracted first and last row, and pieces of the lists of ends of open nodes."""
    rows = len(unit.seq)
    first = unit.ids is not None
    by_len = np.argsort(unit.len, kind="stable")
    lens, depths = unit.len[by_len], unit.entry[1]
    nodes: dict[str, list] = {x: [] for x in ("conv_id", "depth", "parent", "n", "c", "l", "s", "ends", "up", "key")}
    records, pieces = {0: [], rows - 1: []}, []
    lo = hi = mn = n = leaves = saved = np.zeros(0, np.int64)
    opened, where = np.zeros(0, bool), np.zeros(0, np.int64)  # where: a closed node's place among those given out
    count = 0
    for d in range(int(lens[-1]), -1, -1):
        fresh = by_len[np.searchsorted(lens, d) : np.searchsorted(lens, d, "right")]
        starts, ends = np.concatenate((lo, fresh)), np.concatenate((hi, fresh))
        sort = np.argsort(starts, kind="stable")
        starts, ends = starts[sort], ends[sort]
        head = np.flatnonzero(unit.lcp[starts] < d)  # edges of this depth or more have merged the rest
        g_lo, g_hi = starts[head], ends[np.concatenate((head[1:], [len(ends)])) - 1]
        size = len(g_lo)
        of_child = np.searchsorted(g_lo, lo, "right") - 1
        done = ~opened
        g_n, g_mn, g_c, g_l, g_s = np.zeros(size, np.int64), np.full(size, NONE), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for total, child in ((g_n, n), (g_c, np.ones(len(lo), np.int64)), (g_l, leaves), (g_s, saved)):
            np.add.at(total, of_child[done], child[done])
        np.minimum.at(g_mn, of_child[done], mn[done])
        told = slice(np.searchsorted(depths, d), np.searchsorted(depths, d, "right"))
        of_entry = np.searchsorted(g_lo, unit.entry[0][told], "right") - 1
        for total, k in ((g_n, 2), (g_c, 4), (g_l, 5), (g_s, 6)):
            np.add.at(total, of_entry, unit.entry[k][told])
        np.minimum.at(g_mn, of_entry, unit.entry[3][told])
        g_open = np.zeros(size, bool) if final else (g_lo == 0) | (g_hi == rows - 1)
        for g in np.flatnonzero(g_open):
            row = 0 if g_lo[g] == 0 else rows - 1
            records[row].append((d, g_n[g], g_mn[g], g_c[g], g_l[g], g_s[g]))
        up_of = [unit.key(0 if g_lo[g] == 0 else rows - 1, d) if g_open[g] else None for g in range(size)] if g_open.any() else None
        if len(lo):  # parents of the depth below
            child = np.flatnonzero(done)
            at, group = where[child], of_child[child]
            parent, up = nodes["parent"][-1], nodes["up"][-1]
            for p, g in zip(at.tolist(), group.tolist()):
                if up_of is not None and up_of[g] is not None:
                    up[p] = up_of[g]
                else:
                    parent[p] = int(g_mn[g])
        shut = np.flatnonzero(~g_open)
        g_leaves = np.where(g_c == 0, 1, g_l)
        g_saved = g_s + ((g_n - 1) * unit.sizes[unit.at[g_lo] + d - 1] if d else 0)
        text = [NOTHING if first else None] * size
        if first and len(fresh) and d < unit.segment:  # those of a full segment end in the next one, if only at its top
            fresh = np.sort(fresh)
            of_end = np.searchsorted(g_lo, fresh, "right") - 1
            cut = np.flatnonzero(np.concatenate(([True], of_end[1:] != of_end[:-1])))
            for a, b in zip(cut, [*cut[1:], len(fresh)]):
                g, ids = of_end[a], unit.ids[fresh[a:b]].tolist()
                if g_open[g]:
                    pieces += [(up_of[g], [*order, len(pieces)], ",".join(map(str, ids[i : i + PIECE]))) for i in range(0, len(ids), PIECE)]
                else:
                    text[g] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        held = len(shut)
        for name, values in (("conv_id", g_mn[shut]), ("depth", np.full(held, d)), ("n", g_n[shut]), ("c", g_c[shut]), ("l", g_leaves[shut]), ("s", g_saved[shut])):
            nodes[name].append(values)
        nodes["ends"].append([text[g] for g in shut])
        nodes["key"].append([None] * held if first else [unit.key(int(g_lo[g]), d) for g in shut])
        nodes["parent"].append([None] * held)
        nodes["up"].append([None] * held)
        where = np.zeros(size, np.int64)
        where[shut] = np.arange(held)
        count += held
        lo, hi, n, mn, leaves, saved, opened = g_lo, g_hi, g_n, g_mn, g_leaves, g_saved, g_open
    if count:
        flat = {name: np.concatenate(parts) if name in ("conv_id", "depth", "n", "c", "l", "s") else [v for part in parts for v in part] for name, parts in nodes.items()}
        yield _batch(_NODE, count, flat)
    kept = [row for row in dict.fromkeys((0, rows - 1)) if records[row]]
    if kept:
        text = lambda row: unit.sizes[unit.at[row] : unit.at[row] + unit.len[row]].tolist()
        fields = {f"e_{x}": [[int(r[k]) for r in records[row]] for row in kept] for k, x in enumerate(("depth", "n", "mn", "c", "l", "s"))}
        yield _batch(_OPEN, len(kept), {"prefix": [unit.prefix[r] for r in kept], "seq": [unit.seq[r] for r in kept], "sizes": [text(r) for r in kept], **fields})
    if pieces:
        yield _batch(_PIECE, len(pieces), dict(zip(("key", "ord", "ids"), map(list, zip(*pieces)))))


def _batch(kind: int, n: int, fields: dict) -> pa.RecordBatch:
    columns = [pa.array(np.full(n, kind, np.int32)) if name == "kind" else pa.array(fields[name], k) if name in fields else pa.nulls(n, k) for name, k in _KINDS.items()]
    return pa.RecordBatch.from_arrays(columns, list(_KINDS))


def _contracted(rows: DataFrame, first: bool, final: bool, unit_rows: int, segment: int) -> DataFrame:
    by = ["prefix", "seq", *(["conv_id"] if first else [])]
    if final:  # contracted rows, of which the caller has checked the number
        ranged = rows.repartition(1).sortWithinPartitions(*by)
    else:
        ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)

    def step(batches):
        part, unit, held, n, entries = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, unit_rows) if not final else [0]:
                piece = batch.slice(at, unit_rows) if not final else batch
                held.append(piece)
                n += piece.num_rows
                entries += len(piece.column(piece.schema.get_field_index("sizes")).flatten())
                if not final and (n >= unit_rows or entries >= UNIT_ENTRIES):
                    yield from _contract(_Unit(pa.Table.from_batches(held), first, segment), final, (part, unit))
                    unit, held, n, entries = unit + 1, [], 0, 0
        if n:
            yield from _contract(_Unit(pa.Table.from_batches(held), first, segment), final, (part, unit))

    return ranged.mapInArrow(step, _OUT)


# --- the trie --------------------------------------------------------------------------------------------------------


def _ends(pieces: DataFrame) -> DataFrame:
    """(key, sha) of the lists of ends that came in pieces: a list is read in order, a piece at a time."""

    def hashed(batches):
        key, h, out = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        out.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
        if key is not None:
            out.append((key, h.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([v for _, v in out], pa.string())], ["key", "sha"])

    return pieces.repartition("key").sortWithinPartitions("key", "ord").select("key", "ids").mapInArrow(hashed, "key binary, sha string")


def _level(rows: DataFrame, unit_rows: int, segment: int) -> DataFrame:
    """All nodes of the tries of ``rows(conv_id, prefix, seq, sizes, graft, g_c, g_l, g_s)``, parents and ends filled in."""
    tables = [staged(_contracted(rows, True, False, unit_rows, segment), "units")]
    while True:
        left = tables[-1].where(F.col("kind") == _OPEN)
        many, entries = left.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("sizes") + F.size("e_depth")), F.lit(0))).first()
        final = many <= unit_rows and entries <= UNIT_ENTRIES
        tables.append(staged(_contracted(left, False, final, unit_rows, segment), "units"))
        if final:
            break
    nodes = reduce(DataFrame.unionByName, [t.where(F.col("kind") == _NODE) for t in tables])
    open_ = reduce(DataFrame.unionByName, [t.where(F.col("kind") == _NODE) for t in tables[1:]])
    names = open_.select(F.col("key").alias("_key"), F.col("conv_id").alias("_conv"))
    shas = _ends(tables[0].where(F.col("kind") == _PIECE)).select(F.col("key").alias("_at"), "sha")
    small = open_.count() <= BROADCAST_NODES
    hint = F.broadcast if small else (lambda df: df)
    out = nodes.join(hint(names), F.col("up") == F.col("_key"), "left").join(hint(shas), F.col("key") == F.col("_at"), "left")
    return out.select(
        "conv_id", "depth", F.coalesce("parent", "_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("c").alias("n_children"), F.col("l").alias("n_leaves"),
        F.col("s").alias("saved_tokens"), F.coalesce("ends", "sha", F.lit(NOTHING)).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """Nodes of the trie of the sequences ``turns(conv_id, pos, digest, size)`` (pos from 0 without gaps, digest of 16
    bytes) of all ``convs(conv_id)``; a conversation without turns is the root's. Ids are longs and not null.

    Returns per node: conv_id (least member), depth, parent_conv_id (root: null), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. No conversations give no nodes.
    """
    item = F.struct("pos", "digest", "size")
    parts = turns.select("conv_id", F.expr(f"pos div {segment}").alias("seg"), item.alias("t"))
    none = F.lit(None).cast(parts.schema["t"].dataType)
    # A conversation has a row, if an empty one, where it begins and after each full segment: it is a member there.
    begun = convs.select("conv_id", F.lit(0).cast("long").alias("seg"), none.alias("t"))
    full = turns.where(F.col("pos") % segment == segment - 1).select("conv_id", F.expr(f"pos div {segment} + 1").alias("seg"), none.alias("t"))
    rows = parts.unionByName(begun).unionByName(full).groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list("t")).alias("t"))  # a segment at most
    seq = F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), ""))
    rows = staged(rows.select("conv_id", "seg", seq.alias("seq"), F.transform("t", lambda x: x["size"].cast("long")).alias("sizes")), "segments")
    last = rows.agg(F.max("seg")).first()[0]
    empty = F.lit(b"")
    if last:
        whole = rows.where(F.size("sizes") == segment).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seg", F.md5("seq").alias("m")))).alias("m"))
        place = whole.select("conv_id", F.explode(F.sequence(F.lit(1), F.size("m"))).alias("k"), "m")
        before = place.select("conv_id", F.col("k").cast("long").alias("seg"), F.unhex(F.md5(F.array_join(F.transform(F.slice("m", 1, F.col("k")), lambda x: x["m"]), ""))).alias("prefix"))
        rows = staged(rows.join(before, ["conv_id", "seg"], "left").withColumn("prefix", F.coalesce("prefix", empty)), "prefixes")
    else:
        rows = rows.withColumn("prefix", empty)
    out, graft, tops = [], None, None
    for seg in range(last or 0, -1, -1):
        here = rows.where(F.col("seg") == seg)
        none = {c: F.lit(0).cast("long") for c in ("g_c", "g_l", "g_s")}
        if graft is None:
            here = here.withColumns({"graft": F.lit(False), **none})
        else:
            here = here.join(graft, "conv_id", "left").withColumns({"graft": F.col("g_c").isNotNull(), **{c: F.coalesce(c, none[c]) for c in none}})
        nodes = _level(here.select("conv_id", "prefix", "seq", "sizes", "graft", "g_c", "g_l", "g_s"), unit_rows, segment)
        if graft is not None:
            at_top = tops.select("conv_id", F.lit(segment).cast("long").alias("depth"), F.col("ends_sha256").alias("_ends"))
            nodes = nodes.join(at_top, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("_ends", "ends_sha256")).drop("_ends")
        if seg:  # the tops are nodes of the segment before, to which they hand what is below them
            tops = nodes.where("depth = 0")
            graft = tops.where("n_children > 0").select("conv_id", F.col("n_children").alias("g_c"), F.col("n_leaves").alias("g_l"), F.col("saved_tokens").alias("g_s"))
            nodes = nodes.where("depth > 0").withColumn("depth", F.col("depth") + seg * segment)
        out.append(nodes)
    return reduce(DataFrame.unionByName, out)


def conversation_trie(conversations: DataFrame, group: int = 5, most: int = 9, segment: int = SEGMENT, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """The trie of rebuilt ``conversations(conv_id, turn, role, text)``: conversation c has the first h turns of the
    conversation c - c % ``group`` (all if fewer, none if it is absent), then its own turns after its first h, where
    h = crc32(decimal c) % ``most``.

    Turns are ordered by turn, null first; of equal turn numbers by the digest of role and text. Null roles and texts
    are empty. Repeated rows are turns of their own. Rows of null conv_id belong to no conversation and are left out;
    other columns are ignored; an empty table gives no rows. Turns are equal when role and text are (a digest of 128
    bits is compared).
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).alias("size"))
    own = numbered(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], "turns").drop("turn")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = own.where("pos = 0").select("conv_id")
    base = own.where((F.col("pos") < most - 1) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "_base")
    asked = ids.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % group, "_h": h})
    taken = asked.join(base, "_base").where(F.col("pos") < F.col("_h")).select("conv_id", F.lit(0).alias("half"), F.col("pos").alias("k"), "digest", "size")
    kept = own.where(F.col("pos") >= h).select("conv_id", F.lit(1).alias("half"), F.col("pos").alias("k"), "digest", "size")
    turns = numbered(taken.unionByName(kept), "conv_id", [F.col("half"), F.col("k")], "rebuilt")
    return prefix_trie(turns.select("conv_id", "pos", "digest", "size"), ids, segment, unit_rows)


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations; see ``conversation_trie`` for odd rows."""
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: crc32 of the decimal id, bit by bit.
_CRC = "xor(list_reduce(list_transform(range(length(conv_id::varchar)), lambda i: ascii(substr(conv_id::varchar, (i+1)::int, 1))::bigint), lambda a, c: list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(a, c)), 4294967295::bigint), 4294967295::bigint)"
SQL = f"""with o as (select conv_id, m, size, row_number() over (partition by conv_id order by turn nulls first, m)-1 as pos from (select conv_id, turn, octet_length(encode(coalesce(text, ''))) as size, md5(octet_length(encode(coalesce(role, '')))||':'||coalesce(role, '')||coalesce(text, '')) as m from conversations where conv_id is not null)),
 i as (select conv_id, conv_id-conv_id%5 as base, {_CRC}%9 as h from (select distinct conv_id from o)),
 r as (select i.conv_id, 0 as half, pos, m, size from i join o on o.conv_id=i.base and pos<h union all select i.conv_id, 1, pos, m, size from i join o on o.conv_id=i.conv_id and pos>=h),
 t as (select *, row_number() over (partition by conv_id order by half, pos) as d from r),
 q as (select conv_id, d, size, md5(string_agg(m, '' order by d) over (partition by conv_id order by d)) as k from t union all select conv_id, 0, 0, '' from i),
 v as materialized (select *, lag(k) over (partition by conv_id order by d) as up from q),
 g as materialized (select d, k, any_value(up) as up, min(conv_id) as conv_id, count(*) as n, (count(*)-1)*any_value(size) as own from v group by d, k),
 c as (select d-1 as d, up as k, count(*) as c from g where d>0 group by d, up),
 x as (select v.d, v.k, sum(own) as s, count(case when c.c is null then 1 end) as l from g left join c on c.d=g.d and c.k=g.k join v on v.conv_id=g.conv_id and v.d<=g.d group by v.d, v.k),
 e as (select d, k, string_agg(conv_id::varchar, ',' order by conv_id) as ids from (select conv_id, max(d) as d from v group by conv_id) join v using (conv_id, d) group by d, k)
 select g.conv_id, g.d::bigint as depth, f.conv_id as parent_conv_id, g.n::bigint as n_convs, coalesce(c.c, 0)::bigint as n_children, x.l::bigint as n_leaves, x.s::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
  from g join x on x.d=g.d and x.k=g.k left join c on c.d=g.d and c.k=g.k left join e on e.d=g.d and e.k=g.k left join g f on f.d=g.d-1 and f.k=g.up"""

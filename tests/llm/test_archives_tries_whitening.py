"""Archives, prefix tries and whitening: odd rows, and against brute force."""

import base64
import collections
import gzip
import hashlib
import io
import json
import random
import uuid
import zipfile
import zlib

import duckdb
import numpy as np
import pytest

from skyloom.llm import common, prefix_trie, queries, warc, whitening

SF = "/root/testdata/sf0.001"


def rows_of(df, columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


# --- whitening -------------------------------------------------------------------------------------------------------


def test_eigenvectors_of_close_and_equal_eigenvalues():
    rng = np.random.default_rng(5)
    for values in ([5, 5, 5, 3 + 1e-9, 3, 3 - 1e-13, 2, 1.5 + 1e-5, 1.5, *rng.random(30)], [1.0] * 6, [4.0, 0, 0, 0], [1e12, 1e12 * (1 - 1e-12), 7.0], [3.0]):
        q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        e, x = whitening.eigen(v)
        size = max(values)
        assert np.abs(e - np.sort(values)[::-1]).max() <= 4e-15 * size
        assert np.abs(x.T @ x - np.eye(len(values))).max() <= 1e-15
        assert np.abs(v @ x - x * e).max() <= 4e-15 * size


def whitened_by_numpy(vectors, k=8):
    """{place: (deviation, whitened up to sign)}, n, explained; places of vectors that count."""
    good = [i for i, v in enumerate(vectors) if v and all(c is not None and np.isfinite(c) for c in v)]
    dim = max((len(vectors[i]) for i in good), default=0)
    good = [i for i in good if len(vectors[i]) == dim]
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in vectors[i]] for i in good]
    n, s = len(x), [sum(c) for c in zip(*x)]
    off = [[n * a - b for a, b in zip(row, s)] for row in x]
    z = np.array(off, float) / n
    e, q = np.linalg.eigh(z.T @ z / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return good, n, [sum(c * c for c in row) for row in off], np.abs(z @ q / np.sqrt(e)), e / np.trace(z.T @ z / n)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    vectors = [None, [], [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [1.0, float("inf"), 0.0], [1.0, 2.0], [1e30, 0.0, 0.0], *rng.normal(size=(40, 3)).tolist()]
    vectors += [vectors[10]] * 5
    vectors[6] = [float("-inf"), 0.0, 1.0]
    rows = [(None if i % 9 == 8 else i // 2, v, i, 1, 2.0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, n long, whitened double")
    good, n, deviation, y, explained = whitened_by_numpy([v and [None if c is None else float(np.float32(c)) for c in v] for v in vectors])
    got = whitening.whiten(df).collect()
    assert len(got) == 3 * len(good) and {r.n for r in got} == {n} and {r.component for r in got} == {1, 2, 3}
    want = sorted((str(rows[i][0]), c + 1, d, round(y[at, c], 6)) for at, (i, d) in enumerate(zip(good, deviation)) for c in range(3))
    assert sorted((str(r.vec_id), r.component, r.deviation, round(abs(r.whitened), 6)) for r in got) == want
    assert all(abs(r.explained - explained[r.component - 1]) < 1e-12 and r.identity_error < 1e-9 for r in got)
    assert whitening.whiten(df.where("n = 0")).count() == 0
    assert whitening.whiten(df.where("size(embedding) = 0")).count() == 0


def test_whitening_without_variance_and_of_great_entries(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<float>")
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in whitening.whiten(same).collect()} == {(0, None, 0.0, None)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert all(r.whitened is None and r.explained == 0 for r in got if r.component == 2)
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in got if r.component == 1)
    great = spark.createDataFrame([(0, [1e12]), (1, [-1e12]), (2, [1.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(great).collect()} == {None, (3 * 1024 - 1024) ** 2}


def test_whitening_query_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    good, n, deviation, y, explained = whitened_by_numpy([r.embedding for r in table])
    got = {(r.vec_id, r.component): r for r in whitening.op13_embedding_whitening(spark, SF).collect()}
    assert len(got) == 8 * n
    for at, i in enumerate(good):
        for c in range(8):
            r = got[table[i].vec_id, c + 1]
            assert (r.n, r.deviation) == (n, deviation[at]) and abs(abs(r.whitened) - y[at, c]) < 1e-9
            assert abs(r.explained / explained[c] - 1) < 1e-10 and r.identity_error < 1e-9


# --- archives --------------------------------------------------------------------------------------------------------

PAGES = [
    (1, "u", None), (2, None, "x" * 2000), (2, None, "x" * 2000), (5, "a b\n", "x" * 2000), (5, "a", "x" * 2000), (None, "a", "x" * 2000), (None, None, None), (7, "z", "y" * 5), (8, "z", "y" * 5),
    (None, "q", "é" * 600), (None, "q", "é" * 600), (9, "w", "z" * 999), (10, "w", "z" * 999), (11, "long", "long text " * 300_000), (12, "e", ""), (-3, "m", "W" * 1000), (-4, "m", "W" * 1000),
]


def expected(pages):
    text = lambda h: (h or "").encode()
    groups = collections.defaultdict(list)
    for page, _, html in pages:
        if len(text(html)) >= 1000:
            groups[text(html)].append(page)
    out, responded = [], set()
    for page, _, html in pages:
        data = text(html)
        top = max((p for p in groups.get(data, []) if p is not None), default=None)
        revisit = data in groups and (page != top or data in responded)
        if data in groups and page == top:
            responded.add(data)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def summary(records):
    digest = warc.F.when(warc.F.col("record_type") == "revisit", warc.F.col("payload_digest")).otherwise(warc.F.sha1("payload"))
    out = records.select(warc.page_of("record_id").alias("page_id"), warc.F.col("payload_length").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", warc.page_of("refers_to").alias("refers_to"))
    return rows_of(out, COLUMNS)


def test_archives_of_odd_rows(spark, tmp_path):
    rows = [(*row, 1, "d", None) for row in PAGES]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, original int, digest string, number long")
    for size in (300, 1 << 30):
        folder = f"{tmp_path}/{size}"
        made = warc.write_archives(df, folder, archive_bytes=size)
        records = warc.read_records(made)
        assert summary(records) == expected(PAGES)
        assert made.agg({"records": "sum"}).first()[0] == len(PAGES)
        listed = warc.read_records(warc.archives_in(spark, folder), tasks=3)
        assert summary(listed) == expected(PAGES)
        ids = [r.record_id for r in records.select("record_id").collect()]
        assert len(set(ids)) == len(ids)
        full = warc.resolved(records).collect()
        assert sorted(hashlib.sha1(r.payload).hexdigest() for r in full) == sorted(hashlib.sha1((h or "").encode()).hexdigest() for _, _, h in PAGES)
        assert {r.target_uri for r in full} == {None, "u", "a%20b%0A", "a", "z", "q", "w", "long", "e", "m"}
    assert warc.read_records(warc.write_archives(df.where("page_id = 99"), f"{tmp_path}/none")).count() == 0


def record(kind, name, payload):
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


@pytest.mark.parametrize("gz", [False, True])
@pytest.mark.parametrize("indexed", [False, True])
def test_archives_of_other_writers(spark, tmp_path, gz, indexed):
    """A ZIP64 file after other bytes, with a comment that holds the end signature; plain and gzip archives."""
    payloads = [b"one", b"", b"three\r\n\r\n" * 9000, b"PK\x05\x06" * 10]
    parts = [record("resource", f"urn:r:{i}", p) for i, p in enumerate(payloads)]
    parts = [gzip.compress(p) for p in parts] if gz else parts
    name = "data.warc.gz" if gz else "data.warc"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(f"archive/{name}", "w", force_zip64=True) as member:
            member.write(b"".join(parts))
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        if indexed:
            at, lines = 0, []
            for p in parts:
                lines.append(f"com,example)/ 20240101000000 {json.dumps({'offset': str(at), 'length': str(len(p)), 'filename': name})}")
                at += len(p)
            z.writestr("indexes/index.cdxj.gz", gzip.compress("\n".join(sorted(lines)).encode()))
        z.comment = b"a comment PK\x05\x06 of some bytes that are no end record"
    path = f"{tmp_path}/{uuid.uuid4().hex}.zip"
    with open(path, "wb") as f:
        f.write(b"before" * 7 + out.getvalue())
    got = warc.read_records(warc.archives_in(spark, path))
    assert rows_of(got, ["record_id", "record_type", "payload", "payload_digest"]) == sorted(((f"urn:r:{i}", "resource", bytearray(p), hashlib.sha1(p).hexdigest()) for i, p in enumerate(payloads)), key=repr)


def test_zip64_directory_fields():
    """Sizes and offsets that only the ZIP64 fields hold."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("archive/a.warc", b"abc")
        z.writestr("archive/b.warc", b"defg")
        limit, zipfile.ZIP64_LIMIT, count, zipfile.ZIP_FILECOUNT_LIMIT = zipfile.ZIP64_LIMIT, 2, zipfile.ZIP_FILECOUNT_LIMIT, 1
        z._didModify = True
        try:
            z.close()
        finally:
            zipfile.ZIP64_LIMIT, zipfile.ZIP_FILECOUNT_LIMIT = limit, count
    data = out.getvalue()
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    found = warc.directory(io.BytesIO(data), len(data))
    assert [(name, method, data[at : at + size]) for name, method, at, size in found] == [("archive/a.warc", 0, b"abc"), ("archive/b.warc", 0, b"defg")]


def test_deflated_archives_raise(spark, tmp_path):
    with zipfile.ZipFile(f"{tmp_path}/a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc", record("resource", "urn:r", b"x" * 1000))
    with pytest.raises(Exception, match="compressed within"):
        warc.read_records(warc.archives_in(spark, str(tmp_path))).count()


@pytest.mark.parametrize("name,table", [("op11_warc", "pages"), ("op12_conversation_prefix_trie", "conversations")])
def test_queries_against_sql(spark, name, table):
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.sql(queries.SQL[name])
    assert rows_of(queries.QUERIES[name](spark, SF), want.columns) == sorted(want.fetchall(), key=repr)


# --- prefix trie -----------------------------------------------------------------------------------------------------

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not children[k]
    sha = lambda k, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(k)).encode()).hexdigest()
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], sha(k, m)) for k, m in members.items()), key=repr)


def talk(seed):
    r = random.Random(seed)
    rows = []
    for c in [*range(-12, 40), 2**62]:
        for t in range(r.choice([0, 1, 2, 3, 5, 9, 14, 23])):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", None, "a"]), r.choice(["x", "x", "x", "yé", "", None])))
    rows += [(None, 1, "a", "b")] * 3 + [(7, 1, "a", "x")] * 4
    rows += [(c, t, "u", f"same{t}") for c in range(100, 140) for t in range(12)]
    return rows + [(900, t, "u", "v" * (20_000 if t == 3 else 1)) for t in range(60)]


@pytest.mark.parametrize("segment,unit", [(4096, 1 << 16), (4096, 5), (7, 1 << 16)])
def test_trie_against_brute_force(spark, segment, unit):
    """Also in units of a few rows, whose contracted rows meet over several levels, and in short segments."""
    rows = talk(3)
    df = spark.createDataFrame([(*row, 1, 2, "k") for row in rows], "conv_id long, turn long, role string, text string, pos int, seg int, key string")
    assert rows_of(prefix_trie.conversation_trie(df, segment=segment, unit_rows=unit), NODE) == trie(rows)


def test_trie_of_empty_tables_and_turnless_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(df).count() == 0
    alone = [(c, 0, None, None) for c in range(1, 5)]  # the base is absent: many have no turns left
    df = spark.createDataFrame(alone, df.schema)
    assert rows_of(prefix_trie.conversation_trie(df), NODE) == trie(alone)


def test_places_of_a_key_over_many_tasks(spark):
    rows = spark.createDataFrame([(7 if i % 3 else i, i) for i in range(999, -1, -1)], "k long, v long").repartition(5)
    n = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = prefix_trie.numbered(rows, "k", [common_col("v")], "places")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", n)
    got = sorted(r.pos for r in table.where("k = 7").collect())
    assert got == list(range(len(got))) and [r.v for r in table.where("k = 7").orderBy("pos").collect()] == sorted(i for i in range(1000) if i % 3 or i == 7)
    common.discard(table)


def common_col(name):
    return warc.F.col(name)

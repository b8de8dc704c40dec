"""Periodic runs, WARC shards and the conversation prefix trie against brute force."""

import gzip
import hashlib
import io
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import periodic_runs as runs
from touchline.llm import prefix_trie as trie
from touchline.llm import queries
from touchline.llm import warc_shards as warc

SMALL = "/root/testdata/sf0.001"


# ------------------------------------------------------------ 11 periodic runs
def brute_runs(words):
    """Every stretch that agrees with itself q words on, for all q; of equal stretches the smallest q."""
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = {}
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[0], (ids[q:] == ids[:-q]).astype(int), [0]])
        for s, e in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist(), strict=True):
            if e + q - s >= max(6, 4 * q):
                found.setdefault((s, e + q - s), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def tail(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_of_random_words():
    rng = random.Random(3)
    docs = [tail(k, [b"w%d" % rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([0, 1, 5, 6, 7, 20, 60, 200, 700]))]) for k in range(600)]
    found, texts = runs._group(docs)
    for words, got, text in zip(docs, found, texts, strict=True):
        assert got == brute_runs(words)
        assert text == collapsed(words, got)


def test_runs_longer_than_the_blocks():
    """Periods and common extensions of several blocks, nested repeats, a single word over and over."""
    unit = [b"%d" % (i * i % 97) for i in range(150)]
    nested = ([b"a", b"b"] * 5 + [b"c"]) * 6
    docs = [unit * 7 + [b"end"], nested, [b"x"] * 5000, [b"%d" % i for i in range(3000)], ([b"y"] * 80 + [b"z"]) * 9, unit * 4 + unit[:149]]
    found, _ = runs._group(docs)
    for words, got in zip(docs, found, strict=True):
        assert got == brute_runs(words)


def test_extensions_are_whole():
    rng = np.random.default_rng(1)
    ids = np.append(np.tile(rng.integers(0, 3, 40), 30), 99)
    ext = runs.Extensions(ids)
    i = rng.integers(0, len(ids) - 1, 400)
    j = rng.integers(0, len(ids) - 1, 400)
    keep = i < j
    for a, b, n in zip(i[keep].tolist(), j[keep].tolist(), ext.of(i[keep], j[keep]).tolist(), strict=True):
        assert (ids[a : a + n] == ids[b : b + n]).all() and (b + n == len(ids) or ids[a + n] != ids[b + n])


def test_query_of_runs(spark):
    rows = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        words = tail(doc_id, (text or "").encode().split())
        found = brute_runs(words)
        r = rows[doc_id]
        assert r["n_runs"] == len(found)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, found)).hexdigest()


def test_run_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a a a a a a a", "x"), (3, "a a a a a a", "x"), (3, "a a a a a a", "x"), (4, "é é\tb\x0bé", "x"), (5, "w " * 300_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = runs.run_digests(runs.periodic_runs(df)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_runs"], r["length"]) for r in got) == [(0, 7, 1, 7), (1, 0, 0, None), (2, 0, 0, None), (3, 6, 1, 6), (3, 6, 1, 6), (4, 3, 0, None), (5, 300_000, 1, 300_000)]
    assert runs.run_digests(runs.periodic_runs(df.limit(0))).count() == 0


# ------------------------------------------------------------ 12 WARC
BIG = "<p>a page of more than a thousand bytes</p>" * 30
PAGES = [(1, "http://a/ bé", BIG), (2, None, BIG), (None, "u", BIG), (5, "v", BIG), (5, "v", BIG), (4, "z", None), (3, "", ""), (7, "s", "short"), (8, "t", "short"), (9, "é", "é" * 500), (10, "x", "é" * 500), (11, "y", "é" * 499 + "x")]


def expected_records(rows):
    groups = defaultdict(list)
    for i, (p, u, h) in enumerate(rows):
        groups[(h or "").encode()].append((p is not None, p or 0, i))
    out = []
    for data, members in groups.items():
        top = max(members)
        for has, p, i in members:
            again = len(data) >= 1000 and i != top[2]
            out.append((p if has else None, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", (top[1] if top[0] else None) if again else None))
    return sorted(out, key=str)


def listing(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/manifest").select("file", "records", "bytes", "sha256").orderBy("file").collect()]


def test_warc_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, shard string")
    warc.write_warc(df, f"{tmp_dir}/w")
    back = warc.read_warc(spark, f"{tmp_dir}/w", payloads=True)
    assert sorted((tuple(r)[:5] for r in back.collect()), key=str) == expected_records(PAGES)
    texts = {(h or "").encode() for _, _, h in PAGES}
    assert {bytes(r["payload"]) for r in back.where("record_type = 'response'").collect()} == texts
    assert back.where("page_id = 1").first()["url"] == "http://a/%20b%C3%A9"
    assert back.where("page_id = 2").first()["url"] is None


def test_warc_empty_and_all_null(spark, tmp_dir):
    df = spark.createDataFrame([(None, None, None)] * 3, "page_id long, url string, html string")
    assert [tuple(r)[:5] for r in warc.archived(df, f"{tmp_dir}/n").collect()] == [(None, 0, hashlib.sha1(b"").hexdigest(), "response", None)] * 3
    warc.write_warc(df.limit(0), f"{tmp_dir}/e")
    assert listing(spark, f"{tmp_dir}/e") == [] and warc.read_warc(spark, f"{tmp_dir}/e").count() == 0


def test_warc_is_deterministic_and_rolls(spark, tmp_dir):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    warc.write_warc(pages.repartition(7, "url"), f"{tmp_dir}/a", roll=20_000)
    warc.write_warc(pages.orderBy(F.desc("page_id")).coalesce(2), f"{tmp_dir}/b", roll=20_000)
    assert listing(spark, f"{tmp_dir}/a") == listing(spark, f"{tmp_dir}/b")
    files = [f for f, *_ in listing(spark, f"{tmp_dir}/a")]
    assert files and all(open(f"{tmp_dir}/a/{f}", "rb").read() == open(f"{tmp_dir}/b/{f}", "rb").read() for f in files)
    warc.write_warc(pages, f"{tmp_dir}/c", roll=1)  # a file a record
    assert [n for _, n, _, _ in listing(spark, f"{tmp_dir}/c")] == [1] * pages.count()
    assert sorted(tuple(r)[:5] for r in warc.read_warc(spark, f"{tmp_dir}/c").collect()) == sorted(tuple(r)[:5] for r in warc.read_warc(spark, f"{tmp_dir}/a").collect())


def test_warc_commit_can_be_repeated(tmp_dir):
    import os

    import pyarrow as pa

    os.makedirs(f"{tmp_dir}/_temporary")
    open(f"{tmp_dir}/_temporary/t1", "wb").write(b"x")
    row = pa.RecordBatch.from_pylist([{"temporary": "t1", "file": "f1", "records": 1, "bytes": 1, "sha256": ""}])
    for _ in range(2):  # the second attempt finds the work done
        assert [b.to_pylist()[0]["file"] for b in warc._committer(tmp_dir)(iter([row]))] == ["f1"]
    lost = pa.RecordBatch.from_pylist([{"temporary": "t2", "file": "f2", "records": 1, "bytes": 1, "sha256": ""}])
    with pytest.raises(FileNotFoundError):
        list(warc._committer(tmp_dir)(iter([lost])))


def test_warc_damage_is_seen():
    one = warc.record(1, 0, "u", b"payload", None, warc.DATE)
    data = warc.gzip_member(one) + warc.gzip_member(warc.record(2, 0, "u", b"", None, warc.DATE))
    assert [h["WARC-Record-ID"] for h, _ in warc.records_of(io.BytesIO(data))] == ["<urn:x-page:1:0>", "<urn:x-page:2:0>"]
    assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: response")
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_of(io.BytesIO(data[:-5])))
    with pytest.raises(ValueError, match="damaged"):
        list(warc.records_of(io.BytesIO(warc.gzip_member(one[:-8]))))
    with pytest.raises(ValueError, match="does not fit"):
        warc._check({"WARC-Payload-Digest": "sha1:X", "WARC-Record-ID": "r"}, "WARC-Payload-Digest", b"payload")


# ------------------------------------------------------------ 13 prefix trie
def base(c):
    return c - c % 100


def head(c):
    return F.crc32(c.cast("string").cast("binary")) % 6


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((-1 if t is None else t, r or "", x or ""))
    own = {c: [x[1:] for x in sorted(ts, key=lambda z: z[0])] for c, ts in own.items()}
    made = {c: own.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + ts[zlib.crc32(str(c).encode()) % 6 :] for c, ts in own.items()}
    members, below, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    for k in members:
        if k:
            below[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in below[k]) or 1
        saved[k] = sum(saved[x] for x in below[k]) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
    return sorted((
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(below[k]), leaves[k], saved[k], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(k)).encode()).hexdigest())
        for k, m in members.items()), key=str)


CHAT = "conv_id long, turn long, role string, text string"


def got_trie(df):
    return sorted((tuple(r)[:8] for r in trie.prefix_trie(df, base, head).collect()), key=str)


def test_trie_of_random_conversations(spark):
    rng = random.Random(4)
    rows = [(c, t or None, rng.choice(["user", None, "a"]), rng.choice(["x", "yy", None, "zzz"])) for c in [*range(330), 900, 901, 1777] if c != 200 for t in range(rng.choice([1, 1, 2, 4, 7, 30]))]
    rng.shuffle(rows)
    assert got_trie(spark.createDataFrame(rows, CHAT)) == brute_trie(rows)


def test_trie_of_one_long_and_many_equal_conversations(spark):
    """Half of all turns in one conversation, that its copy shares; equal others; references that lead to the texts."""
    rows = [(c, t, "user", f"t{t % 7}") for c in (1, 2) for t in range(1500)] + [(c, t, "user", f"t{t}") for c in range(1000, 1400) for t in range(3)]
    df = spark.createDataFrame(rows, CHAT).repartition(16)
    nodes = trie.prefix_trie(df, base, head)
    assert sorted((tuple(r)[:8] for r in nodes.collect()), key=str) == brute_trie(rows)
    texts = {(c, t + 1): x for c, t, _, x in rows}
    made = {c: [x for cc, _, _, x in rows if cc == c - c % 100][: zlib.crc32(str(c).encode()) % 6] + [x for cc, _, _, x in rows if cc == c][zlib.crc32(str(c).encode()) % 6 :] for c in {r[0] for r in rows}}
    for r in nodes.where("depth > 0").collect():
        assert texts[(r["ref_conv"], r["ref_place"])] == made[r["conv_id"]][r["depth"] - 1]


def test_trie_edges(spark):
    assert got_trie(spark.createDataFrame([], CHAT)) == []
    rows = [(None, 0, "user", "x"), (7, None, None, None), (7, 1, "a", "ab"), (8, 1, "aa", "b"), (9, 5, "user", "long " * 50_000)]
    df = spark.createDataFrame(rows, CHAT).withColumn("digest", F.lit(1)).withColumn("print", F.lit("x"))
    assert got_trie(df) == brute_trie(rows)
    twice = [(7, 1, "a", "b")] * 3
    assert got_trie(spark.createDataFrame(twice, CHAT)) == brute_trie(twice)


def test_products_compose_and_cancel():
    power = trie._powers()
    a, b = [trie._element(hashlib.sha256(bytes([i])).digest()) for i in range(5)], [trie._element(hashlib.sha256(bytes([i, 1])).digest()) for i in range(4)]

    def product(xs):
        out = 0
        for x in xs:
            out = trie.times(out, 1, x, power)
        return out

    assert trie.times(product(a), 4, product(b), power) == product(a + b)
    assert trie.less(product(a + b), 4, product(a), power) == product(b)
    assert product(a) != product(a[::-1])
    assert power(1 << 17) == pow(trie.RADIX, 1 << 17, trie.PRIME)


def test_two_prefixes_of_one_fingerprint_stop_the_job(spark, monkeypatch):
    monkeypatch.setattr(trie, "turn_rows", lambda c: c.select("conv_id", "turn", F.unhex(F.concat(F.lit("00" * 16), F.sha2("text", 256))).alias("digest"), F.lit(1).cast("long").alias("chars")))
    df = spark.createDataFrame([(101, 0, "u", "x"), (105, 0, "u", "y")], CHAT)
    with pytest.raises(Exception, match="one fingerprint"):
        trie.prefix_trie(df, base, lambda c: F.lit(0)).collect()


def test_queries_agree_with_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for name in ("op12_warc_shards", "op13_prefix_trie"):
        rows = queries.QUERIES[name](spark, SMALL)
        want = con.sql(queries.ORACLE_SQL[name])
        assert sorted(rows.columns) == sorted(want.columns)
        assert sorted(map(str, map(tuple, rows.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))

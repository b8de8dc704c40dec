"""Periodic runs of words, by longest common extensions on a difference cover.

The words of many documents are numbered and laid end to end, a number of its
own after each document. Only suffixes that start at cover positions (powers of
two modulo ``V``: the differences of these nine residues are all residues) are
sorted, by hashes of blocks of ``V`` words and prefix doubling over them. The
common extension of two positions compares the fewer than ``V`` words up to
where both are sampled, then takes a range minimum over the sorted suffixes'
common blocks from a sparse table, then compares less than a block more.

A run of period q and four periods or more holds, at some multiple of 2q, words
that agree with those q further on for q + 1 words at least. So the runs come
from the grid of multiples of 2q, for every q (a harmonic sum of pairs): most
pairs fall at a single word, the others are extended right, and left by
bisection. A stretch that several periods give has the smallest of them.

A document is one row of one task: its words, and the sorted samples of the
documents that are done together (``AT_ONCE`` words, or one longer document),
are what a task holds; the grid is walked in slices of ``PAIRS``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.textbatch import constants, mix

V, AT_ONCE, PAIRS = 73, 1 << 18, 1 << 20
LEAST, TIMES = 6, 4  # words of a run at least, and periods
COVER = np.array(sorted(pow(2, k, V) for k in range(9)))
_U = np.uint64
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _cover_tables() -> tuple[np.ndarray, np.ndarray]:
    """For residues a, b the least shift that brings both into the cover, and
    the place of each residue of the cover in it."""
    inside = np.zeros(V, bool)
    inside[COVER] = True
    shift = np.zeros((V, V), np.int64)
    r = np.arange(V)
    for d in range(V - 1, -1, -1):
        moved = inside[(r + d) % V]
        shift[np.ix_(moved, moved)] = d
    place = np.full(V, -1, np.int64)
    place[COVER] = np.arange(len(COVER))
    return shift, place


SHIFT, PLACE = _cover_tables()


class Extensions:
    """Common extensions of positions of ``ids``, whose last number occurs once."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        samples = (np.arange(0, len(ids) + V, V)[:, None] + COVER[None, :]).ravel()
        samples = samples[samples < len(ids)]
        m = len(samples)
        value = np.concatenate([mix(ids.astype(_U) + _U(1)), np.zeros(V, _U)])
        h = np.zeros(m, _U)
        with np.errstate(over="ignore"):
            for k, c in enumerate(constants(V, 1173)):
                h += c * value[samples + k]
        rank = np.unique(h, return_inverse=True)[1].astype(np.int64)
        levels, step = [], len(COVER)  # the sample V further on stands nine places on
        while True:
            levels.append(np.append(rank, -1))
            if m == 0 or rank.max(initial=0) == m - 1:
                break
            ahead = levels[-1][np.minimum(np.arange(m) + step, m)]
            rank = np.unique(rank * (m + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
            step *= 2
        self.rank = rank
        order = np.argsort(rank, kind="stable")
        a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(m - 1, 0), np.int64)
        for t in range(len(levels) - 1, -1, -1):
            same = levels[t][a] == levels[t][b]
            common[same] += 1 << t
            a[same] = np.minimum(a[same] + (len(COVER) << t), m)
            b[same] = np.minimum(b[same] + (len(COVER) << t), m)
        self.least = [common]  # least[t][i]: minimum of 2**t entries from i on
        while len(self.least[-1]) > 1 << (len(self.least) - 1):
            t = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-t], self.least[-1][t:]))

    def _compare(self, i, j, most, out):
        """Add equal words, up to ``most`` of each pair; which pairs reach it."""
        live = np.arange(len(i))
        reached = []
        for k in range(V + 1):
            there = most[live] <= k
            reached.append(live[there])
            live = live[~there]
            if not len(live):
                break
            live = live[self.ids[i[live] + k] == self.ids[j[live] + k]]
            out[live] += 1
        return np.concatenate(reached)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and from j on; i < j, in one document."""
        out = np.zeros(len(i), np.int64)
        d = SHIFT[i % V, j % V]
        on = self._compare(i, j, d, out)
        if len(on):
            a, b = i[on] + d[on], j[on] + d[on]
            ra = self.rank[a // V * len(COVER) + PLACE[a % V]]
            rb = self.rank[b // V * len(COVER) + PLACE[b % V]]
            lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
            t = np.frexp((hi - lo).astype(float))[1] - 1
            blocks = np.empty(len(on), np.int64)
            for k in np.unique(t):
                at = np.flatnonzero(t == k)
                row = self.least[k]
                blocks[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << k)])
            more = np.zeros(len(on), np.int64)
            self._compare(a + V * blocks, b + V * blocks, np.full(len(on), V), more)
            out[on] += V * blocks + more
        return out


def _grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of (start of the document, period, grid position) for all periods
    of all documents; the positions of one period never part."""
    most = np.where(sizes >= LEAST, sizes // TIMES, 0)
    for lo in range(0, len(sizes), 4096):
        at, top = np.arange(lo, min(lo + 4096, len(sizes))), int(most[lo : lo + 4096].max(initial=0))
        q0 = 1
        while q0 <= top:
            wide = max(1, PAIRS // max(1, int((sizes[at] // (2 * q0)).sum())))
            q1 = min(top, q0 + wide - 1)
            d = np.repeat(at, np.clip(most[at] - q0 + 1, 0, q1 - q0 + 1))
            first = np.searchsorted(d, at)
            q = q0 + np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
            count = np.maximum(sizes[d] - 1, 0) // (2 * q)  # positions i with i + 2q inside
            begin = np.cumsum(count) - count
            k = np.arange(count.sum()) - np.repeat(begin, count)
            q = np.repeat(q, count)
            s = np.repeat(starts[d], count)
            yield s, q, s + 2 * q * k
            q0 = q1 + 1
            at = at[most[at] >= q0]


def find_runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in ``ids``), length and period of all runs, by start, then period."""
    ext, found = None, []
    for s, q, i in _grid(starts, sizes):
        for ahead in (lambda q: 0, lambda q: 1, lambda q: q):  # words that agree with those q further on
            x = i + ahead(q)
            keep = np.flatnonzero(ids[x] == ids[x + q])
            s, q, i = s[keep], q[keep], i[keep]
        if not len(i):
            continue
        if ext is None:
            ext = Extensions(ids)
        f = ext.of(i, i + q)
        keep = np.flatnonzero(f > q)
        s, q, i, f = s[keep], q[keep], i[keep], f[keep]
        # Of a stretch's grid positions the first.
        again = np.zeros(len(i), bool)
        again[1:] = (q[1:] == q[:-1]) & (i[1:] - 2 * q[1:] == i[:-1]) & (f[:-1] >= 2 * q[:-1]) & (s[1:] == s[:-1])
        s, q, i, f = s[~again], q[~again], i[~again], f[~again]
        lo, hi = np.maximum(s, i - 2 * q + 1), i.copy()
        while len(at := np.flatnonzero(lo < hi)):
            mid = (lo[at] + hi[at]) // 2
            good = ext.of(mid, mid + q[at]) >= i[at] - mid
            hi[at[good]] = mid[good]
            lo[at[~good]] = mid[~good] + 1
        length = i + q + f - lo
        keep = length >= np.maximum(LEAST, TIMES * q)
        found.append((lo[keep], length[keep], q[keep]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)  # of equal stretches that of the smallest period
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document (by the crc32 of its doc_id) with a tail
    that repeats itself; all others, and those without doc_id, as they are."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _group(docs: list[list[bytes]]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Runs and collapsed text of each document."""
    ids, at = [], 0
    for words in docs:  # numbers are never shared by two documents
        seen: dict[bytes, int] = {}
        ids.append(np.fromiter((seen.setdefault(w, at + len(seen)) for w in words), np.int64, len(words)))
        at += len(seen) + 1
        ids.append(np.array([at - 1]))
    sizes = np.array([len(w) for w in docs], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    start, length, period = find_runs(np.concatenate(ids) if ids else np.empty(0, np.int64), starts, sizes)
    runs, texts = [], []
    edge = np.searchsorted(start, np.append(starts, starts[-1] + sizes[-1] + 1 if len(starts) else 0))
    for k, words in enumerate(docs):
        s, n, q = (x[edge[k] : edge[k + 1]] for x in (start, length, period))
        s = s - starts[k]
        runs.append(list(zip(s.tolist(), n.tolist(), q.tolist(), strict=True)))
        if len(s):
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, s + q, 1)
            np.add.at(step, s + n, -1)
            words = compress(words, (np.cumsum(step[:-1]) == 0).tolist())
        texts.append(b" ".join(words))
    return runs, texts


def _batches(rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            runs, texts = _group(held)
            runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
            return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array([len(w) for w in held], pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(texts, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

        doc_ids, held, total = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                words = (text.as_py() or b"").split()  # of bytes: at the space and 0x09-0x0D alone
                if held and total + len(words) > AT_ONCE:
                    yield done()
                    doc_ids, held, total = [], [], 0
                doc_ids.append(doc_id.as_py())
                held.append(rewrite(doc_ids[-1], words) if rewrite else words)
                total += len(words) + 16
        if held:
            yield done()

    return run


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_words, runs (start, length, period in
    words, by start, then period), collapsed (the words that no run holds after
    its first period, with single spaces). ``rewrite`` changes the words of a
    document first.

    One row per input row, repeated rows too; an empty table gives none. Null
    and empty texts have no words, no runs and an empty collapsed text. Runs of
    equal length are all given. Other columns are not read. Words are compared
    themselves; blocks of ``V`` words by 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = docs.mapInArrow(_batches(rewrite), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return rows.withColumn("collapsed", F.col("collapsed").cast("string"))


def run_digests(rows: DataFrame) -> DataFrame:
    """What ``periodic_runs`` gives -> doc_id, n_runs, the longest run (ties: the
    smallest start, then period), exponent_milli, runs_sha256, collapsed_sha256."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), F.concat(r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))))
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
    return rows.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                       F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")

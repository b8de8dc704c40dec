"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words and the first ``PREFIXES`` bytes of longer words
(inflected forms of one stem share them), each hashed to one of ``2**BITS``
buckets. The fit learns a bias, a linear weight and ``RANK`` factors for every
bucket that tells something of the label, alone or together with another: whose
document counts differ between the labels, or whose joint counts with some
other bucket do beyond what the two do alone (``joint_terms``). So a pair of
terms counts that are both harmless alone, also where neither has an effect of
its own. Scores use every word of every text.

The fit reads at most about ``max_rows`` labelled rows, chosen by the hash of
their doc_id, in one task. What reaches it are the buckets of a row, each once:
``2**BITS`` numbers of four bytes at most however long the text, so no more than
``MOST_TERMS`` in all, as ``max_rows`` falls with the mean number of a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from touchline.llm.shared import materialised
from touchline.llm.textbatch import ALNUM, Hasher, doc_index, list_column, slices, text_bytes

BITS, PREFIXES, RANK = 18, (4, 5, 6), 8
MAX_ROWS, MOST_TERMS, EPOCHS, BATCH, RATE = 24_000, 100_000_000, 20, 64, 0.1
ALONE, TOGETHER, SUPPORT, BLOCK = 4.0, 6.5, 0.02, 512  # standard errors; least share of rows of a term that is looked at in pairs; terms paired at once
_U = np.uint64
MODEL = "bucket int, weight double, factors array<double>"


def _terms(hasher: Hasher, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every term of every word."""
    h, off, more = hasher.words(*text_bytes(column))
    doc = doc_index(off)
    docs, buckets = [doc], [h]
    for p in more:
        long = np.flatnonzero(p)
        docs.append(doc[long])
        buckets.append(p[long])
    return np.concatenate(docs), (np.concatenate(buckets) >> _U(64 - BITS)).astype(np.int32)


def _distinct(doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(doc.astype(np.int64) << BITS | bucket)
    return key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(ALNUM, PREFIXES)
    for batch in batches:
        for part in slices(batch, "text"):
            doc, bucket = _distinct(*_terms(hasher, part.column("text")))
            off = np.searchsorted(doc, np.arange(len(part) + 1))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), list_column(bucket, off, pa.int32())], ["doc_id", "label", "buckets"])


def joint_terms(flat: np.ndarray, row: np.ndarray, residual: np.ndarray, scale: float) -> np.ndarray:
    """Buckets that with some other one tell of the label what is not told yet.

    For every pair of buckets of at least ``SUPPORT`` of the rows (of rarer ones
    a sample this size holds too few common rows to tell), the residual of the
    label is summed over the product of both, each centred, against the
    label's own ``scale``: it is 0 but for chance unless the pair has an effect
    that is not in the scores yet. Pairs are taken block by block; ``TOGETHER``
    standard errors leave about one chance pair in 10**10.
    """
    n = len(residual)
    share = np.bincount(flat, minlength=1 << BITS) / max(n, 1)
    frequent = np.flatnonzero((share >= SUPPORT) & (share <= 1 - SUPPORT))
    if n < 2 or not len(frequent):
        return np.empty(0, np.int64)
    index = np.full(1 << BITS, -1, np.int64)
    index[frequent] = np.arange(len(frequent))
    at = index[flat]
    keep = np.flatnonzero(at >= 0)
    order = keep[np.argsort(at[keep], kind="stable")]
    at, owner = at[order], row[order]
    spread = np.sqrt(share[frequent] * (1 - share[frequent])).astype(np.float32)

    def block(lo: int) -> np.ndarray:
        hi = min(lo + BLOCK, len(frequent))
        a, b = np.searchsorted(at, [lo, hi])
        x = np.zeros((n, hi - lo), np.float32)
        x[owner[a:b], at[a:b] - lo] = 1
        return (x - share[frequent[lo:hi]].astype(np.float32)) / spread[lo:hi]

    found = np.zeros(len(frequent), bool)
    for lo in range(0, len(frequent), BLOCK):
        left = block(lo) * (residual / scale).astype(np.float32)[:, None]
        for other in range(lo, len(frequent), BLOCK):
            z = np.abs(left.T @ (block(other) if other != lo else block(lo)))
            if other == lo:
                np.fill_diagonal(z, 0)
            strong = z > TOGETHER
            found[lo : lo + BLOCK] |= strong.any(1)
            found[other : other + BLOCK] |= strong.any(0)
    return frequent[found]


def fit_fm(rows: list[np.ndarray], label: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Rows of distinct bucket ids and 0/1 labels -> buckets, weights, factors, bias."""
    size = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate(rows) if len(rows) else np.empty(0, np.int32)
    row = np.repeat(np.arange(len(rows)), size)
    n1, n0 = max(1, int(label.sum())), max(1, int((1 - label).sum()))
    c1 = np.bincount(flat[label[row] == 1], minlength=1 << BITS).astype(float)
    c0 = np.bincount(flat[label[row] == 0], minlength=1 << BITS).astype(float)
    p1, p0, p = c1 / n1, c0 / n0, (c1 + c0 + 1) / (n1 + n0 + 2)
    z = np.abs(p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    z[c1 + c0 < 3] = 0
    chosen = np.flatnonzero(z > ALONE)
    if not len(label):
        return chosen.astype(np.int32), np.zeros(0), np.zeros((0, RANK)), 0.0
    w, v, b, score = _descend(flat, row, label, chosen, seed)
    more = joint_terms(flat, row, label - score, max(float(np.sqrt(((label - label.mean()) ** 2).sum())), 1e-9))
    if len(np.setdiff1d(more, chosen)):
        chosen = np.union1d(chosen, more)
        w, v, b, _ = _descend(flat, row, label, chosen, seed)
    return chosen.astype(np.int32), w, v, b


def _raw(f: np.ndarray, o: np.ndarray, n: int, w: np.ndarray, v: np.ndarray, b: float) -> np.ndarray:
    """The machine's sum for ``n`` rows of features ``f`` (of row ``o``)."""
    out = b + np.bincount(o, w[f], n)
    for k in range(v.shape[1]):
        x = v[f, k]
        out += 0.5 * (np.bincount(o, x, n) ** 2 - np.bincount(o, x * x, n))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(flat: np.ndarray, row: np.ndarray, label: np.ndarray, chosen: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Weights and factors of the chosen buckets by AdaGrad, the bias, and each row's score."""
    index = np.full(1 << BITS, -1, np.int32)
    index[chosen] = np.arange(len(chosen))
    have = index[flat] >= 0
    feat, owner = index[flat[have]], row[have]
    off = np.searchsorted(owner, np.arange(len(label) + 1))
    rng = np.random.default_rng(seed)
    m = len(chosen)
    w, v = np.zeros(m), rng.normal(0, 0.01, (m, RANK))
    base = (label.sum() + 1) / (len(label) + 2)
    b = float(np.log(base / (1 - base)))
    gw, gv, gb = np.full(m, 1e-2), np.full((m, RANK), 1e-2), 1e-2
    for _ in range(EPOCHS if m else 0):
        for part in np.array_split(rng.permutation(len(label)), max(1, len(label) // BATCH)):
            count = off[part + 1] - off[part]
            at = np.repeat(off[part] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            f, o = feat[at], np.repeat(np.arange(len(part)), count)
            used, f = np.unique(f, return_inverse=True)
            wu, vu = w[used], v[used]
            vf = vu[f]
            s = np.zeros((len(part), RANK))
            np.add.at(s, o, vf)
            raw = b + np.bincount(o, wu[f], len(part)) + 0.5 * ((s * s).sum(1) - np.bincount(o, (vf * vf).sum(1), len(part)))
            err = _sigmoid(raw) - label[part]
            dw = np.bincount(f, err[o], len(used)) + 1e-3 * wu
            dv = np.zeros((len(used), RANK))
            np.add.at(dv, f, err[o][:, None] * (s[o] - vf))
            dv += 1e-3 * vu
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += err.sum() ** 2
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
            b -= RATE * float(err.sum()) / np.sqrt(gb)
    return w, v, b, _sigmoid(_raw(feat, owner, len(label), w, v, b))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, label, ids = [], [], []
    for batch in batches:
        ids += batch.column("doc_id").to_pylist()
        label += batch.column("label").to_pylist()
        rows += [x.values.to_numpy() for x in batch.column("buckets")]
    order = sorted(range(len(rows)), key=lambda i: (ids[i], len(rows[i])))  # the same fit however the rows arrive
    chosen, w, v, b = fit_fm([rows[i] for i in order], np.array([label[i] for i in order], np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *chosen.tolist()], pa.int32()), pa.array([b, *w.tolist()]), pa.array([[0.0] * RANK, *v.tolist()], pa.list_(pa.float64()))], ["bucket", "weight", "factors"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The model's rows: bucket -1 holds the bias. ``docs`` (doc_id, text),
    ``labels`` (doc_id, toxic). Learns only from labelled rows with
    ``crc32(doc_id as text) mod 3 <> 1``; null ids and null labels are skipped,
    of repeated labels of a document the greater counts. Without any labelled
    row every score is 0.5."""
    known = labels.where("doc_id is not null and toxic is not null").where("crc32(cast(doc_id as string)) % 3 <> 1")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    share = min(1.0, max_rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    # The sample holds about max_rows rows of 12 bytes whatever the input.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    rows = materialised(texts.mapInArrow(_features, "doc_id long, label int, buckets array<int>"))
    terms = rows.agg(F.sum(F.size("buckets"))).first()[0] or 0
    if terms > MOST_TERMS:  # fewer rows of long texts, so that the task's memory is bounded
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 20)) < F.lit(int((1 << 20) * MOST_TERMS / terms)))
    return materialised(rows.repartition(1).mapInArrow(_fit, MODEL))


def _scores(bias: float, index: np.ndarray, w: np.ndarray, v: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ALNUM, PREFIXES)
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column("row").field("text"), batch.column("row")], ["text", "row"])
            for part in slices(texts, "text"):
                doc, bucket = _terms(hasher, part.column("text"))
                have = index[bucket] >= 0
                doc, bucket = _distinct(doc[have], bucket[have])
                raw = _raw(index[bucket], doc, len(part), w, v, bias)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(_sigmoid(raw))], ["row", "score"])

    return run


def scored_rows(docs: DataFrame, model: DataFrame) -> DataFrame:
    """``docs`` (with a string column text, and any others) -> row (a struct of
    all its columns) and a score from 0 to 1; null texts count as empty. The
    model has at most ``2**BITS + 1`` rows."""
    rows = model.collect()
    terms = sorted((r for r in rows if r["bucket"] >= 0), key=lambda r: r["bucket"])
    bias = next((r["weight"] for r in rows if r["bucket"] < 0), 0.0)
    index = np.full(1 << BITS, -1, np.int32)
    index[[r["bucket"] for r in terms]] = np.arange(len(terms))
    w = np.array([r["weight"] for r in terms])
    v = np.array([r["factors"] for r in terms]).reshape(-1, RANK)
    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(_scores(bias, index, w, v), StructType([rows.schema["row"], StructField("score", DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``, repeated
    rows too. held_out is null for a null doc_id."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = scored_rows(plain, train(plain, labels, max_rows)).select("row.doc_id", "score")
    return scored.select("doc_id", F.expr("crc32(cast(doc_id as string)) % 3 = 1").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

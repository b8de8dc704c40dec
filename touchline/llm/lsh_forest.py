"""Near-duplicate documents by an LSH forest of MinHash signatures.

1. Per document: the set of 4-word shingles (64-bit hashes), its size, a
   128-bit digest of the set and ``TREES * DEPTH`` MinHash values.
2. Equal sets become one class, shown by its smallest doc_id.
3. Every tree sorts the classes by its own ``DEPTH`` values. Sorting is by
   range, and the class id ends the key, so a region full of copies is spread
   over many tasks. Within the order a class is compared with the ``REACH``
   classes that follow it as long as they share a prefix of ``SHALLOW``
   values; in a crowded region these are the ones that share the longest
   prefix, so the depth follows the density of the region.
4. Candidates are confirmed on the full sets. Next neighbours of the first
   trees come first; further candidates are confirmed only where they lead
   from one component to another.
5. Where a shared prefix runs beyond ``REACH`` or over the edge of a task, and
   its classes are not all of one component yet, an exact join follows: two
   sets of similarity s share one of the first n - ceil(s n) + 1 of their n
   shingles in any fixed order. The rarest come first, and a shingle of very
   many classes is dealt out over blocks of them.

So no pair is lost to the density of a region. The chance that a
pair of similarity 0.8 shares no prefix in any tree is (1 - 0.8**3)**20 < 6e-7.
Two-bit sketches of the values drop candidates before the exact check, a pair
of similarity 0.8 with a chance below 1e-7; together that is below 7e-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import connected_components
from touchline.llm.shared import bitmap, materialised, may_hold, small_join
from touchline.llm.textbatch import SPACED, Hasher, constants, doc_index, grams, list_column, mix, signed, slices, text_bytes

TREES, DEPTH, SHALLOW, REACH, FIRST_TREES = 20, 8, 3, 12, 3
HOT = 1000  # classes of a shingle in one block of the exact join
SKETCH = TREES * DEPTH // 4  # bytes that hold the low two bits of every MinHash value
SKETCH_MISS = 1e-7  # chance at most that the sketches drop a pair of the least similarity
DIFFERING = np.array([((b | b >> 1) & 0x55).bit_count() for b in range(256)], np.uint8)  # pairs of bits that are not 00
PAIR = ["a", "b", "near", "region"]
_U = np.uint64


def shingle_sets(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document and their offsets. A
    document of fewer than ``k`` words has one shingle, its whole sequence."""
    g, goff, _ = grams(h, off, k)
    few = np.diff(off)
    short = np.flatnonzero((few > 0) & (few < k))
    if len(short):
        own = np.empty(len(short), _U)
        c = constants(k, 99)
        with np.errstate(over="ignore"):
            for i, d in enumerate(short):
                w = h[off[d] : off[d + 1]]
                own[i] = mix((w * c[: len(w)]).sum(keepdims=True) + _U(len(w)))[0]
        g = np.insert(g, goff[short], own)
        goff = goff + np.concatenate([np.zeros(1, np.int64), np.cumsum((few > 0) & (few < k))])
    else:
        g = g.copy()
    for a, b in zip(goff[:-1].tolist(), goff[1:].tolist(), strict=True):
        if b - a > 1:
            g[a:b].sort()
    new = np.ones(len(g), bool)
    new[1:] = g[1:] != g[:-1]
    new[goff[:-1][np.diff(goff) > 0]] = True
    kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(new)])
    return g[new], kept[goff]


def _digests(g: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(off) - 1
    hi, lo, full = np.zeros(n, _U), np.zeros(n, _U), np.diff(off) > 0
    if len(g):
        at = off[:-1][full]
        with np.errstate(over="ignore"):
            hi[full], lo[full] = np.add.reduceat(mix(g ^ _U(0xA5A5A5A5)), at), np.add.reduceat(mix(g + _U(0x1234567)), at)
    return hi, lo


def _minhashes(g: np.ndarray, off: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """(documents, hashes) of 32-bit minima; documents without shingles get 0."""
    out, full = np.zeros((len(off) - 1, len(mult)), ">u4"), np.flatnonzero(np.diff(off) > 0)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(full):  # pieces that stay in the cache
            end = max(at + 1, int(np.searchsorted(off, off[full[at]] + 30_000, "right")) - 1)
            end = max(at + 1, int(np.searchsorted(full, end)))
            rows = full[at:end]
            x, starts = g[off[rows[0]] : off[rows[-1] + 1]], off[rows] - off[rows[0]]
            buf = np.empty_like(x)
            for p in range(len(mult)):
                np.multiply(x, mult[p], out=buf)
                np.add(buf, add[p], out=buf)
                out[rows, p] = np.minimum.reduceat(buf, starts) >> _U(32)
            at = end
    return out


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, mult, add = Hasher(SPACED), constants(TREES * DEPTH, 31), constants(TREES * DEPTH, 57)
        for batch in batches:
            for part in slices(batch, "text"):
                g, off = shingle_sets(*hasher.words(*text_bytes(part.column("text")))[:2], k)
                hi, lo = _digests(g, off)
                sig = _minhashes(g, off, mult, add)
                width = sig.shape[1] * 4
                raw = pa.Array.from_buffers(pa.binary(width), len(sig), [None, pa.py_buffer(sig.tobytes())]).cast(pa.binary())
                two = (sig & 3).astype(np.uint8).reshape(len(sig), -1, 4)
                two = np.ascontiguousarray(two[:, :, 0] | two[:, :, 1] << 2 | two[:, :, 2] << 4 | two[:, :, 3] << 6)
                sketch = pa.Array.from_buffers(pa.binary(SKETCH), len(sig), [None, pa.py_buffer(two.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(off)), pa.array(signed(hi)), pa.array(signed(lo)), raw, sketch], ["doc_id", "n_shingles", "hi", "lo", "sig", "sketch"])

    return run


def most_differing(similar: int) -> int:
    """The fewest differing sketch values that a pair of the least similarity
    exceeds with a chance of ``SKETCH_MISS`` at most."""
    n, p, beyond = TREES * DEPTH, (1 - similar / 100) * 0.75, 0.0  # two bits of different values agree in a quarter of the cases
    for m in range(n, 0, -1):
        beyond += comb(n, m) * p**m * (1 - p) ** (n - m)
        if beyond > SKETCH_MISS:
            return m
    return 0


def _unmet(tree: np.ndarray, keys: np.ndarray, ids: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    region = mix(tree[at].astype(_U) + _U(1))
    for c in range(SHALLOW):
        region = mix(region ^ keys[at, c].astype(_U))
    return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.bool_()), pa.array(signed(region))], PAIR)


def _neighbours(similar: int):
    """Rows (tree, key, id, sketch) in order -> pairs of near classes; and with
    a null ``b`` the classes and regions (tree and prefix) in which a class may
    have partners that it does not meet here: more than ``REACH`` places off, or
    in another task."""
    most = most_differing(similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, ids = np.empty(0, np.int32), np.empty(0, np.int64)
        keys, sketch = np.empty((0, DEPTH), ">u4"), np.empty((0, SKETCH), np.uint8)
        first = 0  # rows at the head of the task so far
        for batch in batches:
            if not batch.num_rows:
                continue
            old = len(ids)
            tree = np.concatenate([tree, batch.column("tree").to_numpy()])
            ids = np.concatenate([ids, batch.column("id").to_numpy()])
            keys = np.concatenate([keys, np.frombuffer(text_bytes(batch.column("key"))[0].tobytes(), ">u4").reshape(-1, DEPTH)])
            sketch = np.concatenate([sketch, text_bytes(batch.column("sketch"))[0].reshape(-1, SKETCH)])
            if first <= REACH:
                yield _unmet(tree, keys, ids, np.arange(min(len(ids), REACH + 1)))
                first = len(ids)
            for j in range(1, REACH + 2):
                if len(ids) <= j:
                    break
                same = (keys[:-j, :SHALLOW] == keys[j:, :SHALLOW]).all(axis=1) & (tree[:-j] == tree[j:]) & (ids[:-j] != ids[j:])
                same[: max(0, old - j)] = False  # seen with the batch before
                at = np.flatnonzero(same)
                if j > REACH:
                    yield _unmet(tree, keys, ids, np.union1d(at, at + j))
                    break
                at = at[DIFFERING[sketch[at] ^ sketch[at + j]].sum(axis=1, dtype=np.int64) <= most]
                if len(at):
                    a, b = ids[at], ids[at + j]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array((tree[at] < FIRST_TREES) & (j == 1)), pa.nulls(len(at), pa.int64())], PAIR)
            tree, ids, keys, sketch = tree[-REACH - 1 :], ids[-REACH - 1 :], keys[-REACH - 1 :], sketch[-REACH - 1 :]
        yield _unmet(tree, keys, ids, np.arange(len(ids)))

    return run


def _full_sets(bits: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACED)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy()
            batch = batch.filter(pa.array(may_hold(bits, ids) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)))
            for part in slices(batch, "text"):
                g, off = shingle_sets(*hasher.words(*text_bytes(part.column("text")))[:2], k)
                hi, lo = _digests(g, off)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(signed(hi)), pa.array(signed(lo)), list_column(signed(g), off, pa.int64())], ["node", "hi", "lo", "items"])

    return run


def _sets_of(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """The sets (node, items) of the texts that ``nodes`` (node) name."""
    bits = bitmap(nodes.select("node"), "node")
    sets = docs.mapInArrow(_full_sets(bits, k), "node long, hi long, lo long, items array<long>").join(nodes, "node", "left_semi")
    return materialised(sets.repartition("node").dropDuplicates(["node", "hi", "lo"]).select("node", "items"))


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Pairs whose full sets have 100 * shared >= similar * union."""
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    both = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
    return both.where(F.col("i") * 100 >= (F.col("n") - F.col("i")) * similar).select("a", "b")


def _unlinked(unmet: DataFrame, found: DataFrame) -> DataFrame:
    """Classes (node, component) of the regions that hold several components."""
    named = unmet.join(found.toDF("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialised(named.select("node", "component", "region"))
    regions = named.groupBy("region").agg((F.min("component") < F.max("component")).alias("mixed"), F.count("*").alias("n"))
    return small_join(named, regions, "region", "n").where("mixed").select("node", "component").distinct()


def _exact_pairs(sets: DataFrame, similar: int) -> DataFrame:
    """``sets`` (node, component, items) -> all pairs (a, b) of different
    components that can have the similarity. A node may have several sets."""
    sets = sets.withColumn("at", F.monotonically_increasing_id())
    each = materialised(sets.select("at", "node", "component", F.explode("items").alias("item")))
    common = each.groupBy("item").agg(F.count("*").alias("n"), F.count("*").alias("rows"), F.min("component").alias("least"), F.max("component").alias("most")).where("n > 1")
    placed = small_join(each, common, "item", "rows", "left").groupBy("at", "node", "component").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "item", F.coalesce(F.col("least") < F.col("most"), F.lit(False)).alias("leads")))).alias("items"))
    size = F.size("items")
    front = placed.select("node", "component", size.alias("size"), F.posexplode(F.slice("items", F.lit(1), (size - F.ceil(size * similar / 100.0 - 1e-9) + 1).cast("int"))).alias("pos", "x"))
    front = materialised(front.where("x.leads").select("node", "component", "size", "pos", "x.item", F.ceil(F.col("x.n") / HOT).cast("int").alias("blocks")))
    own, every = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = front.select("item", own.alias("i"), every.alias("j"), F.col("node").alias("a"), F.col("component").alias("ca"), F.col("size").alias("na"), F.col("pos").alias("pa"))
    right = front.select("item", every.alias("i"), own.alias("j"), F.col("node").alias("b"), F.col("component").alias("cb"), F.col("size").alias("nb"), F.col("pos").alias("pb"))
    # If this is the first shingle that both have, they share no more than follows it in either.
    likely = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) * (100 + similar) >= (F.col("na") + F.col("nb")) * similar)
    return left.join(right, ["item", "i", "j"]).where(likely).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, k: int = 4, similar: int = 80) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, kept.

    One row per input row. Null and empty texts and texts of separators have an
    empty set and link with nothing. doc_id is taken as a key: repeated rows get
    equal answers, and where different texts share a doc_id, the links of any
    of them count for the groups shown by that id. Rows without a doc_id join
    the group of an equal text that has one; otherwise their component_id is
    null and they are kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed_docs = materialised(docs.mapInArrow(_signatures(k), "doc_id long, n_shingles long, hi long, lo long, sig binary, sketch binary"))
    key = ["n_shingles", "hi", "lo"]
    classes = signed_docs.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"))
    width = DEPTH * 4
    trees = classes.select("id", "sig", "sketch", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "tree", F.expr(f"substring(sig, tree * {width} + 1, {width})").alias("key"), "id", "sketch")
    order: list[Column] = [F.col("tree"), F.col("key"), F.col("id")]
    pairs = trees.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours(similar), "a long, b long, near boolean, region long")
    met = materialised(pairs.groupBy("a", "b", "region").agg(F.max("near").alias("near")))
    pairs, unmet = met.where("b is not null").select("a", "b", "near"), met.where("b is null").select(F.col("a").alias("node"), "region")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets_of(docs, nodes, k)
    links = materialised(_confirmed(pairs.where("near").select("a", "b"), sets, similar))
    first = materialised(connected_components(links))
    named = lambda c: first.select(F.col("node").alias(c), F.col("component").alias("c" + c))
    rest = pairs.where("not near").select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left")
    rest = rest.where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b")
    links = materialised(links.union(_confirmed(rest, sets, similar)))
    found = materialised(connected_components(links))
    unlinked = materialised(_unlinked(unmet, found))
    if not unlinked.isEmpty():
        sets = _sets_of(docs, unlinked, k)
        more = _confirmed(_exact_pairs(sets.join(unlinked, "node"), similar), sets, similar)
        found = connected_components(links.union(more))
    # Only classes of several rows or with links need a name other than their own.
    groups = signed_docs.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"))
    groups = groups.join(found.toDF("id", "component"), "id", "left").where("rows > 1 or component is not null")
    groups = groups.select(*key, F.coalesce("component", "id").alias("component"))
    out = signed_docs.select("doc_id", *key).join(groups, key, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                      F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"))

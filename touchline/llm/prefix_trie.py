"""The prefix trie of conversations that are rebuilt from a base's head and their
own suffix.

A turn is known by a reference to where its text is stored (conversation and
place) and the SHA-256 of role and text; texts themselves never move. A stretch of
turns is an element (number of turns, hash) of a monoid,
``(m, x) * (n, y) = (m + n, x * R**n + y)`` modulo a prime of 127 bits, which
also cancels: the product of a stretch is that of a longer one less its
beginning. So the fingerprint of every prefix of a rebuilt conversation follows
from products of prefixes of the base and of the conversation itself.

1. Turns are sorted by range on (conversation, turn); each partition multiplies
   its own stretches. Only a partition's first and last conversation can go on
   in others, so one carried product for each partition makes them whole.
2. A conversation gets the head of its base (at most ``MOST`` turns), and each
   of its turns after that its depth and fingerprint: the rows of the trie's
   members.
3. Members are grouped by (depth, fingerprint) into nodes. That all members of
   a group stand below one parent with one last turn is checked in the same
   aggregate, by the stored digests; if not, the job fails.
4. Sums over subtrees need no walk. Of the conversations in a node the smallest
   owns it, so each conversation owns the end of its path, and a sum over the
   distinct nodes below is one over members, each with what it owns from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import materialised, small_join

PRIME, RADIX = (1 << 127) - 1, int.from_bytes(hashlib.sha256(b"turn").digest()[:15])
MOST = 5  # turns of a head
PIECE = 2048  # conversation ids hashed at once
EMPTY = (0).to_bytes(16)
TURN = "conv_id long, turn long, digest binary, chars long"
_PLACED = "part int, conv_id long, place long, before binary, product binary, chars_before long, chars long, digest binary"


def _powers() -> Callable[[int], int]:
    known = [1]

    def power(n: int) -> int:
        if n >= 1 << 16:
            return pow(RADIX, n, PRIME)
        while len(known) <= n:
            known.append(known[-1] * RADIX % PRIME)
        return known[n]

    return power


def times(product: int, n: int, more: int, power: Callable[[int], int]) -> int:
    """The product of a stretch and of the ``n`` turns after it."""
    return (product * power(n) + more) % PRIME


def less(product: int, n: int, beginning: int, power: Callable[[int], int]) -> int:
    """The product of the last ``n`` turns of a stretch with this beginning."""
    return (product - beginning * power(n)) % PRIME


def _element(digest: bytes) -> int:
    return int.from_bytes(digest[:16]) % PRIME


def _number(value: bytes) -> int:
    return int.from_bytes(value)


def _batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_PLACED_ARROW = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("place", pa.int64()), ("before", pa.binary()), ("product", pa.binary()), ("chars_before", pa.int64()), ("chars", pa.int64()), ("digest", pa.binary())])


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and products within a sorted partition, from its own first turn of
    each conversation on."""
    conv, place, product, total = None, 0, 0, 0
    for batch in batches:
        out: dict[str, list] = {f.name: [] for f in _PLACED_ARROW}
        for c, digest, chars in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), batch.column("chars").to_pylist(), strict=True):
            if c != conv:
                conv, place, product, total = c, 0, 0, 0
            after = (product * RADIX + _element(digest)) % PRIME
            place += 1
            for name, value in (("conv_id", c), ("place", place), ("before", product.to_bytes(16)), ("product", after.to_bytes(16)), ("chars_before", total), ("chars", chars), ("digest", digest)):
                out[name].append(value)
            product, total = after, total + chars
        out["part"] = batch.column("part").to_pylist()
        yield _batch(out, _PLACED_ARROW)


def _carried(carry: dict[tuple[int, int], tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = _powers()
        for batch in batches:
            out = batch.to_pydict()
            for k, key in enumerate(zip(out["part"], out["conv_id"], strict=True)):
                if key in carry:
                    n, product, chars = carry[key]
                    here = out["place"][k]
                    out["before"][k] = times(product, here - 1, _number(out["before"][k]), power).to_bytes(16)
                    out["product"][k] = times(product, here, _number(out["product"][k]), power).to_bytes(16)
                    out["place"][k] += n
                    out["chars_before"][k] += chars
            yield _batch(out, _PLACED_ARROW)

    return run


def placed_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, digest, chars) -> each turn's place in its
    conversation from 1 on, the products before and through it and the code
    points before it. A conversation of any length is spread over as many
    partitions as its turns ask for; equal turn numbers are ordered by digest."""
    rows = turns.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest").withColumn("part", F.spark_partition_id())
    rows = materialised(rows.mapInArrow(_local, _PLACED))
    # One row for each partition's first and one for its last conversation.
    last = rows.groupBy("part", "conv_id").agg(F.max(F.struct("place", "product", (F.col("chars_before") + F.col("chars")).alias("chars"))).alias("end"))
    edges = rows.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    held = last.join(F.broadcast(edges), "part").where("conv_id = low or conv_id = high").select("part", "conv_id", "end.*").collect()
    carry, conv, so_far, power = {}, None, (0, 0, 0), _powers()
    for r in sorted(held, key=lambda r: (r["part"], r["conv_id"])):
        if r["conv_id"] != conv:
            conv, so_far = r["conv_id"], (0, 0, 0)
        elif so_far[0]:
            carry[(r["part"], conv)] = so_far
        so_far = (so_far[0] + r["place"], times(so_far[1], r["place"], _number(r["product"]), power), so_far[2] + r["chars"])
    return rows.mapInArrow(_carried(carry), _PLACED) if carry else rows


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, chars of every row with a conv_id: role and text
    (null: empty) as a digest in which neither runs into the other."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit("\n"), role, text), 256))
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))


_MEMBER_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("print", pa.binary()), ("above", pa.binary()), ("digest", pa.binary()), ("chars", pa.int64()), ("rest", pa.int64()), ("ends", pa.bool_()), ("ref_conv", pa.int64()), ("ref_place", pa.int64())])
MEMBER = "conv_id long, depth long, print binary, above binary, digest binary, chars long, rest long, ends boolean, ref_conv long, ref_place long"


def _own_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of the prefixes that end in a conversation's own suffix:
    the head's product times the suffix's, which is the own product less its beginning."""
    power = _powers()
    for batch in batches:
        got = batch.to_pydict()
        out: dict[str, list] = {n: got[n] for n in ("conv_id", "depth", "digest", "chars", "rest", "ends", "ref_conv", "ref_place")} | {"print": [], "above": []}
        for place, skip, before, product, head, own in zip(got["ref_place"], got["skip"], got["before"], got["product"], got["head_product"], got["own_product"], strict=True):
            n, head, own = place - skip, _number(head), _number(own or EMPTY)
            out["print"].append(times(head, n, less(_number(product), n, own, power), power).to_bytes(16))
            out["above"].append(times(head, n - 1, less(_number(before), n - 1, own, power), power).to_bytes(16))
        yield _batch(out, _MEMBER_ARROW)


def rebuilt_members(conversations: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column]) -> DataFrame:
    """A row for each conversation and each prefix of its rebuilt turns, the
    empty one too: conv_id, depth, print, above (the fingerprint without the
    last turn), digest and chars of the last turn, rest (code points from the
    last turn on), ends (whether it is the whole), ref_conv and ref_place (where
    the last turn is stored).

    ``base`` gives the conversation whose first ``head`` turns, at most ``MOST``,
    replace as many of a conversation's own; fewer where the base has fewer.
    """
    turns = materialised(placed_turns(turn_rows(conversations)))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.col("chars_before") + F.col("chars")).alias("own_chars"))
    first = turns.where(F.col("place") <= MOST)
    entry = F.struct("place", "before", "product", "chars_before", "chars", "digest")
    firsts = first.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("first"))  # at most MOST entries
    convs = convs.join(firsts, "conv_id").withColumn("base", base(F.col("conv_id"))).withColumn("h", head(F.col("conv_id")).cast("int"))
    heads = firsts.select(F.col("conv_id").alias("base"), F.col("first").alias("lent")).join(convs.groupBy("base").agg(F.count("*").alias("lends")), "base")
    convs = small_join(convs, heads, "base", "lends", "left")
    none = F.array().cast(convs.schema["first"].dataType)
    convs = convs.withColumn("lent", F.slice(F.coalesce("lent", none), F.lit(1), F.col("h")))
    lent, own = F.try_element_at("lent", F.lit(-1)), F.when(F.col("h") > 0, F.try_element_at(F.slice("first", F.lit(1), F.col("h")), F.lit(-1)))
    own_rest = F.when(F.col("n") > F.col("h"), F.col("own_chars") - F.coalesce(own["chars_before"] + own["chars"], F.lit(0))).otherwise(0)
    convs = convs.select(
        "conv_id", "base", "lent", F.col("h").cast("long").alias("skip"), F.size("lent").cast("long").alias("n_head"), "own_chars",
        F.coalesce(lent["product"], F.lit(EMPTY)).alias("head_product"), F.coalesce(own["product"], F.lit(EMPTY)).alias("own_product"),
        F.coalesce(lent["chars_before"] + lent["chars"], F.lit(0)).alias("head_chars"), own_rest.alias("own_rest"),
        (F.size("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("size"), F.col("n").alias("own_turns"))
    convs = materialised(convs)
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(EMPTY).alias("print"), F.lit(None).cast("binary").alias("above"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"),
                        (F.col("head_chars") + F.col("own_rest")).alias("rest"), (F.col("size") == 0).alias("ends"), F.lit(None).cast("long").alias("ref_conv"), F.lit(None).cast("long").alias("ref_place"))
    x = F.col("x")
    of_head = convs.select("*", F.explode("lent").alias("x")).select("conv_id", x["place"].alias("depth"), x["product"].alias("print"), x["before"].alias("above"), x["digest"].alias("digest"), x["chars"].alias("chars"),
                                                                   (F.col("head_chars") - x["chars_before"] + F.col("own_rest")).alias("rest"), (x["place"] == F.col("size")).alias("ends"), F.col("base").alias("ref_conv"), x["place"].alias("ref_place"))
    what = convs.select("conv_id", "skip", "n_head", "head_product", "own_product", "own_chars", "size", "own_turns")
    own_turns = small_join(turns, what, "conv_id", "own_turns").where("place > skip")
    own_turns = own_turns.withColumn("depth", F.col("n_head") + F.col("place") - F.col("skip")).withColumn("rest", F.col("own_chars") - F.col("chars_before")).withColumn("ends", F.col("depth") == F.col("size"))
    own_turns = own_turns.select("conv_id", "depth", "skip", "before", "product", "head_product", "own_product", "digest", "chars", "rest", "ends", F.col("conv_id").alias("ref_conv"), F.col("place").alias("ref_place"))
    return root.unionByName(of_head).unionByName(own_turns.mapInArrow(_own_members, MEMBER))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, print, conv_id) -> runs of ids of one node, comma-joined."""
    schema = pa.schema([("depth", pa.int64()), ("print", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    node, first, ids = None, 0, []
    for batch in batches:
        done = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("depth", "print", "conv_id")), strict=True):
            if row[:2] != node or len(ids) == PIECE:
                if ids:
                    done.append((*node, first, ",".join(ids)))
                node, first, ids = row[:2], row[2], []
            ids.append(str(row[2]))
        if done:
            yield _batch(dict(zip(schema.names, map(list, zip(*done, strict=True)), strict=True)), schema)
    if ids:
        yield _batch(dict(zip(schema.names, ([node[0]], [node[1]], [first], [",".join(ids)]), strict=True)), schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces -> the SHA-256 of each node's ids, a piece at a time."""
    schema = pa.schema([("depth", pa.int64()), ("print", pa.binary()), ("ends_sha256", pa.string())])
    node, digest = None, None
    for batch in batches:
        done = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("depth", "print", "ids")), strict=True):
            if row[:2] != node:
                if digest:
                    done.append((*node, digest.hexdigest()))
                node, digest = row[:2], hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(row[2].encode())
        if done:
            yield _batch(dict(zip(schema.names, map(list, zip(*done, strict=True)), strict=True)), schema)
    if digest:
        yield _batch(dict(zip(schema.names, ([node[0]], [node[1]], [digest.hexdigest()]), strict=True)), schema)


def end_digests(members: DataFrame) -> DataFrame:
    """depth, print, ends_sha256: the ids of the conversations that end in a node,
    ascending. A node's ids are joined by range; one hash has to see them in
    order, so its pieces meet in one task, which holds one at a time."""
    ends = members.where("ends").select("depth", "print", "conv_id").repartitionByRange("depth", "print", "conv_id").sortWithinPartitions("depth", "print", "conv_id")
    pieces = ends.mapInArrow(_pieces, "depth long, print binary, first long, ids string")
    return pieces.repartition("depth", "print").sortWithinPartitions("depth", "print", "first").mapInArrow(_joined, "depth long, print binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column]) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) -> a row for each node of the
    trie of the rebuilt conversations: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256,
    ref_conv and ref_place (where its last turn is stored).

    Turns are in the order of ``turn``, null first, equal ones by digest;
    repeated rows are turns of their own. Null roles and texts are empty. Rows
    without conv_id belong to no conversation and are left out. An empty table
    has no node. Other columns are not read.
    """
    members = materialised(rebuilt_members(conversations, base, head))
    node = ["depth", "print"]
    same = [F.min(c).eqNullSafe(F.max(c)) for c in ("above", "digest")]
    smallest = F.min(F.struct("conv_id", "ref_conv", "ref_place", "rest"))
    nodes = members.groupBy(*node).agg(F.count("*").alias("n_convs"), smallest.alias("of"), F.count_if("ends").alias("n_ends"), F.sum("rest").alias("all_rest"), F.min("above").alias("above"), (same[0] & same[1]).alias("same"))
    agreed = F.when(F.col("same"), F.col("n_ends")).otherwise(F.raise_error(F.lit("two different prefixes have one fingerprint; choose another RADIX")).cast("long"))
    nodes = materialised(nodes.select(*node, "above", "n_convs", agreed.alias("n_ends"), "all_rest", "of.*"))

    # What each conversation owns: the end of its path, and its last node if that has no child.
    owned = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "rest")).alias("first"), F.max((F.col("n_ends") == F.col("n_convs")).cast("int")).alias("leaf"), F.count("*").alias("size"))
    sizes = members.groupBy("conv_id").agg(F.count("*").alias("size"))
    owned = sizes.join(owned.drop("size"), "conv_id").select("conv_id", F.col("first.depth").alias("owns_from"), F.col("first.rest").alias("owned_rest"), "leaf", "size")
    parts = small_join(members.select("conv_id", *node, "rest"), owned, "conv_id", "size")
    sums = parts.groupBy(*node).agg(F.sum(F.when(F.col("depth") >= F.col("owns_from"), F.col("rest")).otherwise(F.col("owned_rest"))).alias("distinct_rest"), F.sum("leaf").alias("n_leaves"))

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above").alias("print")).agg(F.count("*").alias("n_children"))
    out = nodes.join(sums, node).join(children, node, "left").join(end_digests(members), node, "left")
    parents = nodes.join(children, node).select(F.struct("depth", "print").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = out.where("depth > 0").withColumn("parent", F.struct((F.col("depth") - 1).alias("depth"), F.col("above").alias("print")))
    below = small_join(below, parents, "parent", "n_children")
    out = below.drop("parent").unionByName(out.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", (F.col("all_rest") - F.col("distinct_rest")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "ref_conv", "ref_place")

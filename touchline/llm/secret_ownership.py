"""Secrets, told from widely copied examples by who holds them.

Candidates are the three base forms and long mixed tokens. Each candidate's
hash is aggregated over the corpus to the number of distinct owners and of
distinct repositories that hold it. A value that ``copied`` or more owners or ``spread``
or more repositories hold is an example; one that fewer hold looks live. Mixed tokens are no secrets by
form alone, so only those that look live are added as spans; base spans stay,
and each is told apart by its verdict.

SQL functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import materialised, small_join
from touchline.llm.spans import count_of, in_order, matches, outside, written

# The base forms, possessive where that changes no match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"[0-9a-f]{32,}+"
MIXED = r"(?:\G|(?<![A-Za-z0-9+/_-]))[A-Za-z0-9+/_-]{20,}+"
KINDS = ("assign", "access", "hex", "live")
COPIED, SPREAD = 3, 10


def _mixed(v: Column) -> Column:
    """Upper and lower case letters and digits, and many different characters."""
    return v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]") & (F.size(F.array_distinct(F.split(v, ""))) >= 12)


def candidates(text: Column) -> Column:
    """Spans of base secrets and of mixed tokens ("live"), with their values."""
    return F.concat(
        matches(text, ASSIGN, "assign", 0, text.rlike(ASSIGN), lambda v: F.length(v) >= 8, group=1),
        matches(text, ACCESS, "access", 1, text.contains("AKIA"), lambda v: F.lit(True)),
        matches(text, HEX, "hex", 2, text.rlike(HEX), lambda v: F.lit(True)),
        matches(text, MIXED, "live", 3, text.rlike(MIXED), _mixed),
    )


def find_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", copied: int = COPIED, spread: int = SPREAD) -> DataFrame:
    """``docs`` (doc_id, text, and the owner and repository columns) -> row,
    doc_id, hits: for every input row its candidates with the owners and
    repositories that hold the value, and ``live``. A null owner or repository
    counts as one of its own; null and empty texts have no candidates, and an
    empty table gives no rows. Just ``copied`` owners or ``spread`` repositories
    are enough for an example. A text of any length is searched whole."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.concat(F.lit("="), F.col(owner).cast("string")), F.lit("")).alias("owner"), F.coalesce(F.concat(F.lit("="), F.col(repository).cast("string")), F.lit("")).alias("repository"))
    hashed = F.transform("hits", lambda h: F.struct(h["kind"].alias("kind"), h["k"].alias("k"), h["start"].alias("start"), h["end"].alias("end"), F.xxhash64(h["value"]).alias("hash")))
    rows = docs.select("doc_id", "owner", "repository", candidates(F.col("text")).alias("hits")).withColumn("hits", hashed)
    rows = materialised(rows.withColumn("row", F.monotonically_increasing_id()))
    each = rows.where("size(hits) > 0").select("row", "owner", "repository", F.explode("hits").alias("hit")).select("row", "owner", "repository", "hit.*")
    # Distinct holders first: what is shuffled per value grows with its holders, not with its copies.
    held = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n")).groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    held = held.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n"))
    judged = small_join(each, held, "hash", "n").select("row", F.struct("start", "k", "end", "kind", "owners", "repositories", ((F.col("owners") < copied) & (F.col("repositories") < spread)).alias("live")).alias("hit"))
    judged = judged.groupBy("row").agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    return rows.select("row", "doc_id").join(judged, "row", "left").select("row", "doc_id", F.coalesce("hits", F.array()).alias("hits"))


def secret_report(docs: DataFrame, owner: str = "source", repository: str = "doc_id", copied: int = COPIED, spread: int = SPREAD) -> DataFrame:
    """One row per input row: counts and spans of the base forms; ``spans`` with
    the live mixed tokens that no base span covers; n_live base spans that look
    live and n_example that are widely copied."""
    found = materialised(find_secrets(docs, owner, repository, copied, spread))
    base, live = F.filter("hits", lambda h: h["kind"] != "live"), F.filter("hits", lambda h: (h["kind"] == "live") & h["live"])
    mixed = found.where(F.size(live) > 0)
    spans = lambda c: mixed.select("row", F.explode(c).alias("h")).select("row", "h.start", "h.end")
    kind = F.struct("start", F.lit(3).alias("k"), "end", F.lit("live").alias("kind"))
    more = outside(spans(live), spans(base)).groupBy("row").agg(F.collect_list(kind).alias("more"))
    found = found.join(more, "row", "left").withColumn("base", base)
    found = found.withColumn("all", F.concat(in_order(F.col("base")), F.coalesce("more", F.array())))
    return found.select(
        "doc_id", *[count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(written(in_order(F.col("base"))), 256).alias("base_sha256"), written(in_order(F.col("all"))).alias("spans"),
        F.size(F.filter("base", lambda h: h["live"])).cast("long").alias("n_live"), F.size(F.filter("base", lambda h: ~h["live"])).cast("long").alias("n_example"))

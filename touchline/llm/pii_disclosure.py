"""Personal data, and the terms that give it away.

Direct identifiers (email, ip, card, phone) are found by their form. Each
distinct value is a protected entity; a term is a run of letters and digits of
any length. Over the whole corpus, the documents that hold a term and an entity
are counted, as are those of the term and of the entity, by their whole texts. With IC(e) = -log2 p(e) and PMI(t; e) = log2 p(t, e) / (p(t) p(e)),
a term discloses the share PMI / IC of what there is to know about the entity;
1 means that it occurs only with it. Terms whose share reaches ``threshold``
in at least ``support`` documents are marked wherever they stand in a document
that holds the entity, and the sanitised text has them removed as it has the identifiers.

SQL functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import materialised, small_join
from touchline.llm.spans import count_of, in_order, matches, outside, replaced, written

# The forms, possessive where that changes no match. A run of a
# class is entered only at its start or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
OCTET = r"^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
TERM = r"[\p{L}\p{M}\p{N}]++"
THRESHOLD, SUPPORT = 0.75, 3


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")


def _same() -> Column:
    return F.struct(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")).alias("same")


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Spans of the four direct identifiers, kind after kind."""
    octets = lambda v: F.forall(F.split(v, r"\."), lambda x: x.rlike(OCTET))
    card = lambda v: F.length(_digits(v)).between(14, 19) & F.call_function("luhn_check", _digits(v))
    return F.concat(
        matches(text, EMAIL, "email", 0, text.contains("@"), lambda v: F.lit(True)),
        matches(text, IP, "ip", 1, text.rlike(r"[0-9]\.[0-9]"), octets),
        matches(text, CARD, "card", 2, text.rlike(CARD), card),
        matches(text, PHONE, "phone", 3, text.contains("+"), lambda v: F.length(_digits(v)).between(10, 15)),
    )


def _row_set() -> list[Column]:
    """128 bits that show a set of distinct rows, whatever their order."""
    return [F.bit_xor(F.xxhash64("row")).alias("set1"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("set2")]


def _disclosed(marked: DataFrame, with_term: DataFrame, total: int, threshold: float, support: int) -> DataFrame:
    """``marked`` (row, entities, words) of all rows with identifiers, and in how
    many documents each term stands -> the terms (row, term) to be marked.

    Entities that stand in the same rows disclose alike, as do terms: one class
    of each is paired, so copies of a text count once however many values they
    repeat. As both stand together in no more documents than the term alone,
    a share of ``threshold`` needs with_term <= total^(1 - threshold) *
    with_entity^threshold; terms beyond that meet no entity.
    """
    most = lambda n: F.pow(F.lit(float(total)), F.lit(1 - threshold)) * F.pow(n, F.lit(threshold)) * (1 + 1e-9)
    held = marked.select("row", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.count("*").alias("with_entity"), *_row_set())
    entities = entities.where((F.col("with_entity") >= support) & (F.col("with_entity") < total))
    entities = materialised(entities.select("entity", "with_entity", F.xxhash64("with_entity", "set1", "set2").alias("ec"), F.col("with_entity").alias("n")))
    widest = entities.agg(F.max("with_entity")).first()[0] or 0
    held = small_join(held, entities, "entity", "n").select("row", "ec", "with_entity").distinct()
    words = marked.select("row", F.explode(F.array_distinct(F.transform("words", lambda t: t["term"]))).alias("term"))
    terms = words.groupBy("term").agg(F.count("*").alias("n"), *_row_set()).where(F.col("n") >= support).join(with_term, "term").where(F.col("with_term") <= most(F.lit(float(widest))))
    words = materialised(small_join(words, terms.select("term", "with_term", F.xxhash64("with_term", "n", "set1", "set2").alias("tc"), "n"), "term", "n"))
    row_entities = held.groupBy("row").agg(F.collect_list(F.struct("ec", "with_entity")).alias("entities"))
    row_terms = words.select("row", "tc", "with_term").distinct().groupBy("row").agg(F.collect_list(F.struct("tc", "with_term")).alias("terms"))
    rows = materialised(row_entities.join(row_terms, "row"))
    pairs = rows.select("row", F.explode("entities").alias("e"), "terms")
    pairs = pairs.select("row", "e.*", F.explode(F.filter("terms", lambda t: t["with_term"] <= most(F.col("e.with_entity")))).alias("t")).select("row", "ec", "with_entity", "t.*")
    both = pairs.groupBy("ec", "with_entity", "tc", "with_term").agg(F.count("*").alias("both")).where(F.col("both") >= support)
    bits = F.log2(F.lit(float(total)))
    share = (bits + F.log2("both") - F.log2("with_entity") - F.log2("with_term")) / (bits - F.log2("with_entity"))
    disclosing = both.where(share >= threshold).select(F.struct("ec", "tc").alias("pair"), F.col("both").alias("n"))
    told = small_join(pairs.select("row", "tc", F.struct("ec", "tc").alias("pair")), disclosing, "pair", "n").select("row", "tc").distinct()
    return words.join(told, ["row", "tc"]).select("row", "term")


def find_pii(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` (doc_id, text) -> row, doc_id, same, base, terms: the spans of
    direct identifiers and of disclosing terms of every input row, repeated rows
    too; ``same`` is a hash of the text.

    Null and empty texts have none, an empty table gives no rows, and a null
    doc_id stays null. A share that equals ``threshold`` counts. A text of any
    length is searched whole; what it costs grows with its words and with its
    classes of entities times its classes of terms.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text())
    found = docs.select("doc_id", "text", base_spans(F.col("text")).alias("hits"))
    occurrences = F.transform(matches(F.col("text"), TERM, "term", 4, F.size("hits") > 0, lambda v: F.lit(True)), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.xxhash64(F.lower(t["value"])).alias("term")))
    entity = lambda h: F.xxhash64(F.concat_ws(":", h["kind"], F.lower(h["value"])))
    hits = materialised(found.select("doc_id", _same(), "hits", F.array_distinct(F.transform("hits", entity)).alias("entities"), occurrences.alias("words")).withColumn("row", F.monotonically_increasing_id()))
    marked = hits.where("size(hits) > 0")
    words = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda v: F.lower(v)))
    with_term = docs.select(F.explode(words).alias("term")).groupBy(F.xxhash64("term").alias("term")).agg(F.count("*").alias("with_term")).where(F.col("with_term") >= support)
    told = materialised(_disclosed(marked, with_term, hits.count(), threshold, support))
    each = marked.select("row", F.explode("words").alias("w")).select("row", "w.*").join(told, ["row", "term"])
    near = marked.select("row", F.explode("hits").alias("h")).select("row", "h.start", "h.end").join(told.select("row").distinct(), "row", "left_semi")
    kind = F.struct(F.lit("term").alias("kind"), F.lit(4).alias("k"), F.col("start"), F.col("end"))
    extra = outside(each, near).groupBy("row").agg(F.array_sort(F.collect_list(kind)).alias("terms"))
    base = F.transform("hits", lambda h: F.struct(h["kind"].alias("kind"), h["k"].alias("k"), h["start"].alias("start"), h["end"].alias("end"), h["value"].alias("value")))
    return hits.select("row", "doc_id", "same", base.alias("base")).join(extra, "row", "left").select("row", "doc_id", "same", "base", F.coalesce("terms", F.array()).alias("terms"))


def pii_report(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """One row per input row: counts and spans of the direct identifiers, and
    ``spans`` with the disclosing terms among them."""
    found = find_pii(docs, threshold, support)
    bare = lambda c: F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select(
        "doc_id", *[count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(written(in_order(F.col("base"))), 256).alias("base_sha256"),
        written(in_order(F.concat(bare(F.col("base")), F.col("terms")))).alias("spans"), F.size("terms").cast("long").alias("n_term"))


def sanitised(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """doc_id and the text of every input row with every span replaced by its
    kind. The spans follow from the text alone, so rows with the same doc_id, or
    none, keep their own."""
    found = find_pii(docs, threshold, support)
    bare = lambda c: F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end")))
    spans = found.select("same", in_order(F.concat(bare(F.col("base")), F.col("terms"))).alias("spans"))
    spans = spans.groupBy("same").agg(F.first("spans").alias("spans"), F.count("*").alias("n"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text()).withColumn("same", _same())
    return small_join(texts, spans, "same", "n").select("doc_id", replaced(F.col("text"), F.col("spans")).alias("text"))

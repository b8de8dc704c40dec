"""Regular-expression matches with their places, in SQL functions alone.

``split`` and ``regexp_extract_all`` walk a text alike, so the lengths of the
parts between matches and of the matches give each match's start. Sums over
them go by blocks, which keeps texts with very many matches linear in effect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64
SPAN = "array<struct<kind:string,k:int,start:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once; a column that is named
    inside a lambda would be computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(lengths: Column) -> Column:
    """Sums of the elements before each element of an int array."""
    zero = F.lit(0).cast("int")
    total = lambda xs: F.aggregate(xs, zero, lambda a, x: (a + x).cast("int"))

    def inside(ls: Column, base: Column, b: Column) -> Column:
        return let(F.slice(ls, b * BLOCK + 1, F.lit(BLOCK)), lambda own: F.transform(own, lambda _, i: (base + total(F.slice(own, F.lit(1), i))).cast("int")))

    def sums(ls: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / BLOCK).cast("int")), lambda b: total(F.slice(ls, b * BLOCK + 1, F.lit(BLOCK))))
        return let(blocks, lambda bs: F.flatten(F.transform(bs, lambda _, b: inside(ls, total(F.slice(bs, F.lit(1), b)), b))))

    return let(lengths, sums)


def matches(text: Column, pattern: str, kind: str, order: int, when: Column, passes: Callable[[Column], Column], group: int = 0, context: int = 0) -> Column:
    """Array of spans of ``pattern`` in ``text`` (code points, end exclusive)
    whose value (its ``group``) passes; empty where ``when`` is not true, which
    spares the search. With ``context``, left and right hold as many code
    points around the match as far as the next match, one more where the text
    goes on, a space where it does not."""
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def spans(p: Column, f: Column, v: Column) -> Column:
        # What lies before match i: i whole parts and matches; its own part is added below.
        starts = running_sums(F.zip_with(F.slice(p, F.lit(1), F.size(f)), f, lambda a, b: F.length(a) + F.length(b)))

        def one(s: Column, i: Column) -> Column:
            at = (s + F.length(F.get(p, i))).cast("int")
            fields = [F.lit(kind).alias("kind"), F.lit(order).alias("k"), at.alias("start"), (at + F.length(F.get(f, i))).cast("int").alias("end"), F.get(v, i).alias("value")]
            if context:
                left, right = F.get(p, i), F.get(p, i + 1)
                fields += [F.when(F.length(left) <= context, F.concat(F.lit(" "), left)).otherwise(F.right(left, F.lit(context + 1))).alias("left"),
                           F.when(F.length(right) <= context, F.concat(right, F.lit(" "))).otherwise(F.left(right, F.lit(context + 1))).alias("right")]
            return F.struct(*fields)

        return F.filter(F.transform(starts, one), lambda x: passes(x["value"]))

    inner = let(F.struct(parts.alias("p"), found.alias("f"), values.alias("v")), lambda x: F.when(F.size(x["f"]) > 0, spans(x["p"], x["f"], x["v"])))
    return F.coalesce(F.when(when, inner), F.array())


def outside(words: DataFrame, hits: DataFrame) -> DataFrame:
    """The ``words`` (row, start, end) that overlap none of the ``hits`` (row,
    start, end) of their row: two sorts of a document's spans instead of every
    word against every hit."""
    spans = words.select("row", "start", "end", F.lit(False).alias("hit")).union(hits.select("row", "start", "end", F.lit(True)))
    up, down = Window.partitionBy("row").orderBy("start", F.desc("hit")), Window.partitionBy("row").orderBy(F.desc("start"))
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("before", F.max(F.when(F.col("hit"), F.col("end"))).over(so_far(up))).withColumn("after", F.min(F.when(F.col("hit"), F.col("start"))).over(so_far(down)))
    free = F.coalesce(F.col("before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True))
    return spans.where(~F.col("hit") & free).select("row", "start", "end")


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined with commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed, then end."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def merged(spans: Column) -> Column:
    """Ordered spans, those that overlap put together; the first one's kind stays."""
    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["kind"].alias("kind"), last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] > s["start"]), joined).otherwise(F.concat(acc, F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))))

    return F.aggregate(spans, F.array().cast("array<struct<kind:string,start:int,end:int>>"), step)


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with each (merged) span replaced by its kind in brackets."""
    def pieces(m: Column) -> Column:
        each = F.transform(m, lambda s, i: F.concat(
            F.substring(text, F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(F.lit(0)) + 1, s["start"] - F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(F.lit(0))),
            F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.concat(F.concat_ws("", each), F.substring(text, F.coalesce(F.element_at(m, -1)["end"], F.lit(0)) + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(merged(spans), pieces)).otherwise(text)

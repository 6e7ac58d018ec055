"""Helpers shared by the text operators of this subpackage.

Everything here is plain DataFrame code.  Operators carry the caller's row in one struct (``whole_row``) beside their own
columns, so that extra columns of any name cannot clash with them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.session import durable, ensure_checkpoint_dir

__all__ = ["BROADCAST_BYTES", "WS", "apart_from", "ascii_lower", "bitmap", "durable", "ensure_checkpoint_dir", "in_bitmap",
           "let", "marked_apart", "match_spans", "maybe_broadcast", "scan_array", "table", "whole_row", "words"]

#: White space between words, as every word rule of this subpackage has it.
WS = r"[\x20\x09-\x0D]+"

#: A side is broadcast only when its counted rows times its row width stay below this.
BROADCAST_BYTES = 32 << 20

#: Bits of the fixed-size membership filter of :func:`bitmap`.
BITMAP_BITS = 1 << 18

#: Items that :func:`scan_array` takes at a time.
SCAN = 256

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__doc")


def words(text: Column) -> Column:
    """White-space separated words; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS, -1), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone.  ``lower`` does the same, faster, where the text is pure ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body reads it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan_array(items: Column, zero: Column, step: Callable[[Column, Column], Column],
               emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """``array<kind>`` of ``emit(state, item)``, with ``state`` starting at ``zero`` and going on by ``step(state, item)``.

    Appending to an array copies it, so items are taken in stretches of SCAN: the states at their beginnings first, then
    each stretch on its own.  Work grows as n * SCAN + (n / SCAN) ** 2, not as n ** 2.
    """
    none = F.array().cast(f"array<{kind}>")

    def within(part: Column, state: Column) -> Column:
        return F.aggregate(part, F.struct(state.alias("at"), none.alias("out")), lambda a, x: F.struct(
            step(a["at"], x).alias("at"), F.concat(a["out"], F.array(emit(a["at"], x))).alias("out")), lambda a: a["out"])

    def stretches(xs: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / SCAN).cast("int")), lambda k: F.slice(xs, k * SCAN + 1, SCAN))

        def all_of(parts: Column) -> Column:
            begin = F.aggregate(parts, F.struct(zero.alias("at"), F.array(zero).alias("out")), lambda a, part: let(
                F.aggregate(part, a["at"], step), lambda at: F.struct(at.alias("at"), F.concat(a["out"], F.array(at)).alias("out"))), lambda a: a["out"])
            return let(begin, lambda at: F.flatten(F.transform(parts, lambda part, k: within(part, F.get(at, k)))))

        return let(cut, all_of)

    return let(items, lambda xs: F.when(F.size(xs) <= SCAN, within(xs, zero)).otherwise(stretches(xs)))


def match_spans(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """``array<struct<s,e>>``: code point spans of the leftmost non-overlapping matches, end exclusive.

    The matches and the stretches between them come from the same regular expression; adding up their
    lengths gives the positions.  Matches for which ``keep(match)`` is not true are dropped, not retried.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kind = "struct<s:int,e:int>"

    def positions(m: Column) -> Column:
        parts = F.zip_with(F.split(text, pattern, -1), m, lambda g, x: F.struct(
            F.length(g).alias("g"), F.coalesce(F.length(x), F.lit(0)).alias("m"),
            (F.coalesce(keep(x), F.lit(False)) if keep else x.isNotNull()).alias("ok")))
        spans = scan_array(parts, F.lit(0), lambda at, x: at + x["g"] + x["m"], lambda at, x: F.when(x["ok"], F.struct(
            (at + x["g"]).alias("s"), (at + x["g"] + x["m"]).alias("e"))), kind)
        return F.filter(spans, lambda x: x.isNotNull())

    return let(found, lambda m: F.when(F.size(m) > 0, positions(m)).otherwise(F.array().cast(f"array<{kind}>")))


def marked_apart(spans: Column, others: Column) -> Column:
    """``array<struct<x,apart>>``: ``spans`` (structs with ``s`` and ``e``, not empty) by start, and whether none of ``others`` overlaps them.

    About n log n: in order of the starts, a span overlaps one before it if the furthest end so far is past its start, and
    one after it if the next start lies before its end.
    """
    far = (1 << 31) - 1
    tag = lambda x, own, whole: F.struct(x["s"].alias("s"), F.lit(own).alias("own"), x["e"].alias("e"), whole.alias("x"))

    def merged(own: Column, other: Column) -> Column:
        none = F.get(own, F.lit(-1))
        return F.array_sort(F.concat(F.transform(other, lambda x: tag(x, 0, none)), F.transform(own, lambda x: tag(x, 1, x))))

    def checked(xs: Column) -> Column:
        reached = scan_array(xs, F.lit(0), lambda a, x: F.when(x["own"] == 0, F.greatest(a, x["e"])).otherwise(a), lambda a, x: a <= x["s"], "boolean")
        follows = F.reverse(scan_array(F.reverse(xs), F.lit(far), lambda a, x: F.when(x["own"] == 0, x["s"]).otherwise(a), lambda a, x: a >= x["e"], "boolean"))
        rows = F.arrays_zip(xs.alias("i"), reached.alias("a"), follows.alias("b"))
        return F.transform(F.filter(rows, lambda r: r["i"]["own"] == 1), lambda r: F.struct(r["i"]["x"].alias("x"), (r["a"] & r["b"]).alias("apart")))

    alone = lambda own: F.transform(own, lambda x: F.struct(x.alias("x"), F.lit(True).alias("apart")))
    return let(spans, lambda own: let(others, lambda other: F.when(
        (F.size(other) == 0) | (F.size(own) == 0), alone(own)).otherwise(let(merged(own, other), checked))))


def apart_from(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``, by start."""
    return F.transform(F.filter(marked_apart(spans, others), lambda r: r["apart"]), lambda r: r["x"])


def bitmap(values: DataFrame, column: str) -> Column:
    """A membership filter of fixed size over a bigint column: an array literal of 2**18 bits.

    Its size does not depend on the data; more values only make it let more rows through, which the
    join that follows it removes.
    """
    bit = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    rows = (values.where(F.col(column).isNotNull())
            .select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 64) as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).collect())   # at most 4,096 rows
    bits = [0] * (BITMAP_BITS // 64)
    for r in rows:
        bits[r["w"]] = r["b"]
    return F.from_json(F.lit(json.dumps(bits)), "array<bigint>")


def in_bitmap(value: Column, bits: Column) -> Column:
    bit = F.pmod(value, F.lit(BITMAP_BITS))
    return F.getbit(F.get(bits, F.shiftright(bit, 6).cast("int")), F.pmod(value, F.lit(64)).cast("int")) == 1


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, hinted for broadcasting only if its counted rows stay below BROADCAST_BYTES.

    Pass a materialised (checkpointed) frame; beyond the bound Spark shuffles and splits skewed keys.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df

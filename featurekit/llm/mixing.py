"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Sources, by code point with NULL last, weigh 5, 2, 1, repeating; together they get as many words as all
   documents have.  A target stops at 3 times its source's words; the excess is shared again by weight.
2. The words are dealt out in blocks of ``BLOCK_WORDS``: each next block goes to the source with the
   highest quotient target / (2 * blocks + 1).  A source's blocks are dealt to its shards in the same way.
3. A shard holds documents by a hash of their id, in seeded order, end to end.  Its quota is full passes
   over the shard, then a run of blocks that starts at a seeded place.  A document's share is the overlap
   of its words with them, so it never exceeds 3 times its size.

The highest quotients are found without dealing blocks one by one: with P parties, weights w (sum W) and N
seats, the divisor W / (N - P/2) gives at most N seats and leaves at most P, of which party i gets at most
w_i * P / W + 1; only those quotients are ranked.  Documents are shuffled once, without their text, by
(source, shard); a hot source is many shards.

NULL texts have size 0 and take 0, as do all documents of an empty table's sources.  Order and shard hang
on the seed, ``doc_id`` and size alone, so reruns agree; repeated rows are dealt like different documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurekit.llm.common import durable, maybe_broadcast, table, whole_row, words

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 16
#: Documents per shard, about.
SHARD_DOCS = 1000
SEED = 7


def targets(sources: DataFrame) -> DataFrame:
    """``__src, __size`` with ``__target``: shares by weight, none above 3 times its size.  One row per source."""
    order = Window.orderBy(F.col("__src").asc_nulls_last())      # a row per source, not per document
    ranked = durable(sources.withColumn("__w", F.get(F.array(*[F.lit(w) for w in WEIGHTS]),
                                                     (F.row_number().over(order) - 1) % len(WEIGHTS)).cast("double")))
    total = ranked.agg(F.coalesce(F.sum("__size"), F.lit(0)).alias("t")).first()["t"]
    cap, share, capped = MAX_REPEAT * F.col("__size"), None, -1
    while True:
        above = F.lit(False) if share is None else share * F.col("__w") >= cap
        r = ranked.agg(F.sum(F.when(above, cap).otherwise(0)).alias("c"), F.sum(F.when(~above, F.col("__w")).otherwise(0)).alias("w"),
                       F.sum(above.cast("long")).alias("n")).first()
        if r["n"] is None or r["n"] == capped or not r["w"]:
            break
        capped, share = r["n"], F.lit(float((total - r["c"]) / r["w"]))
    if share is None:
        return ranked.withColumn("__target", F.lit(0.0))
    return durable(ranked.withColumn("__target", F.least(share * F.col("__w"), cap.cast("double"))))


def apportion(parties: DataFrame, group: list[str], order: list[Column], weight: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague: ``parties`` with ``out``, the seats won among the parties of ``group`` (``seats`` in all).

    Ties go by ``order``.  Parties without weight win none.
    """
    keys = [F.col(c) for c in group] or [F.lit(0)]
    over = Window.partitionBy(*keys)
    alive = (parties.where(F.col(weight) > 0)
             .withColumn("__P", F.count("*").over(over)).withColumn("__W", F.sum(F.col(weight).cast("double")).over(over)))
    free = F.col(seats) - F.col("__P") / 2
    base = alive.withColumn("__base", F.when(free > 0, F.floor(F.col(weight) * free / F.col("__W") + 0.5)).otherwise(0).cast("long"))
    base = base.withColumn("__left", F.col(seats) - F.sum("__base").over(over))
    more = F.floor(F.col(weight) * F.col("__P") / F.col("__W")).cast("long") + 2
    quotient = F.col(weight) / (2 * (F.col("__base") + F.col("__k")) - 1)
    ranked = (base.withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), more)))
              .withColumn("__rank", F.row_number().over(over.orderBy((F.col("__k") > 0).asc(), quotient.desc(), *order, "__k"))))
    # the rows with k = 0 stand for the seats already won and come first
    won = ranked.withColumn("__won", F.when(F.col("__k") == 0, F.col("__base")).otherwise(
        (F.col("__rank") - F.col("__P") <= F.col("__left")).cast("long")))
    cols = [F.col(f"`{c}`") for c in parties.columns]
    won = won.groupBy(*cols).agg(F.sum("__won").alias(out))
    return won.unionByName(parties.where(~(F.coalesce(F.col(weight) > 0, F.lit(False)))).withColumn(out, F.lit(0).cast("long")))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` without its text: ``__doc`` (the other columns), ``size, source_size, target, taken``."""
    cols = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    h = F.md5(F.concat_ws("|", F.lit(str(SEED)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = docs.select(F.struct(*cols).alias("__doc"), F.col("source").alias("__src"), h.alias("__h"), F.col("doc_id").alias("__id"),
                        F.size(words(F.col("text"))).cast("long").alias("size"))
    sources = targets(sized.groupBy("__src").agg(F.sum("size").alias("__size"), F.count("*").alias("__docs")))
    total = sources.agg(F.coalesce(F.sum("__target"), F.lit(0.0)).alias("t")).first()["t"]
    by_source = apportion(sources.withColumn("__seats", F.lit(round(total / BLOCK_WORDS)).cast("long")), [],
                          [F.col("__src").asc_nulls_last()], "__target", "__seats", "__quota")
    by_source = durable(by_source.withColumn("__shards", F.ceil(F.col("__docs") / SHARD_DOCS))
                        .select(F.xxhash64("__src").alias("__s"), "__size", "__target", "__quota", "__shards"))
    # one row per source; joined by the hash of its name, so that NULL is a source too
    dealt = (sized.withColumn("__s", F.xxhash64("__src")).join(maybe_broadcast(by_source, 80), "__s")
             .withColumn("__shard", F.pmod(_number(F.col("__h")), F.col("__shards"))))
    shards = dealt.groupBy("__s", "__shard").agg(F.sum("size").alias("__words"), F.first("__quota").alias("__quota"))
    quotas = apportion(shards, ["__s"], [F.col("__shard")], "__words", "__quota", "__won").select("__s", "__shard", "__words", "__won")
    line = Window.partitionBy("__s", "__shard").orderBy("__h", "__id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("size").over(line)
    # Join the quotas first: the window then finds the rows dealt by (source, shard) already.
    placed = (dealt.join(quotas, ["__s", "__shard"]).withColumn("__end", end).withColumn("__from", F.col("__end") - F.col("size")))
    blocks = F.ceil(F.col("__words") / BLOCK_WORDS)
    won = F.least(F.col("__won"), MAX_REPEAT * blocks)
    full = F.when(blocks > 0, F.floor(won / blocks)).otherwise(0).cast("long")
    rest = F.when(blocks > 0, won - full * blocks).otherwise(0)
    place = _number(F.md5(F.concat_ws("|", F.lit(f"{SEED} start"), F.coalesce("__src", F.lit("null")), F.col("__shard").cast("string"))))
    begin = F.when(blocks > 0, F.pmod(place, blocks)).otherwise(0) * BLOCK_WORDS
    overlap = lambda a, b: F.greatest(F.lit(0), F.least(F.col("__end"), b) - F.greatest(F.col("__from"), a))
    until = begin + rest * BLOCK_WORDS
    round_trip = blocks * BLOCK_WORDS           # the run of blocks goes on at the shard's first block
    run = overlap(begin, F.least(until, round_trip)) + overlap(F.lit(0), until - round_trip)
    return placed.select("__doc", "size", F.col("__size").alias("source_size"), F.col("__target").alias("target"),
                         (full * F.col("size") + run).cast("long").alias("taken"))


def mix_report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select("__doc.doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes words of, with ``taken`` (words, repeats counted) and ``copies`` (of the whole text);
    ``mix_taken`` and so on where ``docs`` has a column of that name.

    Texts don't pass through the apportionment: they are joined again by a hash of the row, of which
    repeated rows take the sum.
    """
    names = []
    for name in ("taken", "copies"):
        while name in docs.columns:
            name = f"mix_{name}"
        names.append(name)
    row = lambda prefix="": F.xxhash64(*[F.col(f"{prefix}`{c}`") for c in docs.columns if c != "text"])
    plan = mix(docs).withColumn("__row", row("__doc."))
    taken = (plan.groupBy("__row", F.col("size").alias("__words")).agg(F.sum("taken").alias("__sum"), F.count("*").alias("__n")))
    share = F.col("__sum") / F.col("__n")
    own = docs.select(whole_row(docs), row().alias("__row"), F.size(words(F.col("text"))).cast("long").alias("__words"))
    return (own.join(taken, ["__row", "__words"]).where(F.col("__sum") > 0)
            .select("__doc.*", share.cast("long").alias(names[0]), F.round(share / F.greatest(F.col("__words"), F.lit(1)), 4).alias(names[1])))


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))

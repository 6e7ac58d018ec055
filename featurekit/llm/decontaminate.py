"""Benchmark decontamination: prefix-filtered set join with exact containment over item-sized windows.

A window is 13 consecutive words of an item, or all words of a shorter one.  A document holds a window
only if it holds all its words, so by the prefix filter one word is enough to find it: the rarest, by
document frequency over all documents (windows with a word of frequency 0 can't occur and go).  The
documents' words are compared with a filter of fixed size; only positions that pass are exploded and
joined with the prefix words.  Position and length bounds and a comparison of the whole window follow.

One pass counts frequencies, one finds hits; texts are never shuffled unless their document holds a prefix
word.  NULL or empty texts have no words and are clean; repeated items count once (``item_id`` NULL: its
windows hit, but it has no id to report); repeated documents are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import ascii_lower, bitmap, durable, in_bitmap, maybe_broadcast, table, whole_row

WINDOW = 13
#: A document is contaminated if 1 of so many words or more is hit.
SHARE = 20
#: Between words: everything in ASCII but digits and letters (after lower-casing A-Z).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def bench_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN, -1), "")


def item_windows(items: DataFrame, docs: DataFrame) -> DataFrame:
    """Windows that can occur: ``__win`` words, ``__items`` ids, ``__token`` rarest word, ``__off`` its place; materialised."""
    w, n = F.col("__w"), F.size("__w")
    wins = (items.select(F.col("item_id").cast("string").alias("__item"), bench_words(F.col("text")).alias("__w"))
            .where(n > 0)
            .select("__item", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))),
                                                    lambda i: F.slice(w, i, WINDOW))).alias("__win"))
            .groupBy("__win").agg(F.sort_array(F.collect_set("__item")).alias("__items")))
    wins = durable(wins)
    vocab = durable(wins.select(F.explode("__win").alias("__token")).distinct())
    bits = bitmap(vocab.select(F.xxhash64("__token").alias("h")), "h")
    seen = docs.select(F.explode(F.array_distinct(F.filter(
        bench_words(F.col("text")), lambda x: in_bitmap(F.xxhash64(x), bits)))).alias("__token"))
    df = (seen.groupBy("__token").agg(F.count("*").alias("__df"))
          .join(maybe_broadcast(vocab, 40), "__token", "left_semi"))
    tokens = wins.select("__win", F.explode(F.array_distinct("__win")).alias("__token")).join(df, "__token", "left")
    rarest = (tokens.groupBy("__win").agg(F.min(F.struct(F.coalesce("__df", F.lit(0)).alias("df"), F.col("__token").alias("t"))).alias("r"))
              .where(F.col("r.df") > 0))
    return durable(wins.join(rarest, "__win").select(
        "__win", "__items", F.col("r.t").alias("__token"), (F.array_position("__win", F.col("r.t")) - 1).cast("int").alias("__off")))


def _hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``__doc`` (the row), ``__n`` words, ``__hit`` words hit and ``__ids``, the sorted ids of the items found."""
    wins = item_windows(items, docs)
    bits = bitmap(wins.select(F.xxhash64("__token").alias("h")), "h")
    none = F.array().cast("array<string>")
    marked = (docs.select(whole_row(docs), bench_words(F.col("text")).alias("__w"))
              .withColumn("__pos", F.filter(F.transform("__w", lambda x, i: F.when(in_bitmap(F.xxhash64(x), bits), i)),
                                            lambda i: i.isNotNull())))
    clean = marked.where(F.size("__pos") == 0).select("__doc", F.size("__w").cast("long").alias("__n"),
                                                      F.lit(0).cast("long").alias("__hit"), none.alias("__ids"))
    at, first = F.col("__at"), F.greatest(F.col("__at") - (WINDOW - 1), F.lit(0))
    rows = (marked.where(F.size("__pos") > 0).withColumn("__row", F.monotonically_increasing_id())
            .select("__row", "__doc", "__w", F.posexplode("__pos").alias("__k", "__at"))
            .select("__row", F.when(F.col("__k") == 0, F.col("__doc")).alias("__doc"), F.size("__w").alias("__n"), "__at",
                    F.get("__w", at).alias("__token"), first.alias("__first"),
                    F.slice("__w", first + 1, F.lit(2 * WINDOW - 1)).alias("__near")))
    size, start = F.size("__win"), at - F.col("__off")
    same = ((start >= 0) & (start + size <= F.col("__n"))
            & (F.slice("__near", start - F.col("__first") + 1, size) == F.col("__win")))
    found = (rows.join(maybe_broadcast(wins, 500), "__token", "left")
             .withColumn("__ok", F.coalesce(F.when(start >= 0, same), F.lit(False)))
             .groupBy("__row").agg(
                 F.first("__doc", ignorenulls=True).alias("__doc"), F.first("__n").cast("long").alias("__n"),
                 F.collect_set(F.when(F.col("__ok"), F.sequence(start, start + size - 1))).alias("__cover"),
                 F.collect_set(F.when(F.col("__ok"), F.col("__items"))).alias("__ids"))
             .select("__doc", "__n", F.size(F.array_distinct(F.flatten("__cover"))).cast("long").alias("__hit"),
                     F.array_sort(F.array_distinct(F.flatten("__ids"))).alias("__ids")))
    return clean.unionByName(found)


_CONTAMINATED = (lambda: (F.col("__hit") > 0) & (SHARE * F.col("__hit") >= F.col("__n")))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, words hit, items found, verdict."""
    return _hits(docs.select("doc_id", "text"), items.select("item_id", "text")).select(
        "__doc.doc_id", F.col("__n").alias("n_words"), F.col("__hit").alias("n_hit"), F.size("__ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("__ids", ","), 256).alias("items_sha256"), _CONTAMINATED().alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that aren't contaminated; the columns of ``docs``."""
    return _hits(docs, items.select("item_id", "text")).where(~_CONTAMINATED()).select("__doc.*")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Quality rules: cross-document line frequency per host, then depleted documents.

1. Lines are normalised (lower case, digits folded, white space folded) and hashed together with their
   host (``source``).  A count of all lines finds those that occur in at least ``MIN_DOCS`` places.
2. Of these alone, distinct documents are counted per host.  Copies are one document, not many: exact
   copies share a text hash, near copies are told by what a document has of its own.  Its own lines are those not
   counted in 1, but for edits of such lines (half of the line's word pairs stand in counted lines of the host).
   The least hash of the own lines' word pairs is the document's class, however many lines a template has.
   Documents without a line of their own are told apart by the two least hashes of their other counted lines.
   A line is boilerplate if its documents are of ``MIN_DOCS`` classes and the classes are at least ``MIN_VARIETY``
   of the documents, either among those with own lines or among all.  Otherwise a page copied a thousand times
   would lose every line of its own.
3. Lines above both limits are removed; a document is rejected if the base rules fail or if fewer than
   ``MIN_KEPT`` of its words are left.

Shuffles carry hashes and counts; only documents that hold a removed line are exploded, found by a filter
of fixed size.  NULL texts have no words and fail the base rule; NULL hosts are one host.  Repeated rows
are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import WS, bitmap, durable, in_bitmap, let, maybe_broadcast, table, words

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
REPEAT_WINDOW = 8
#: A line is removed from a host if at least so many distinct documents of the host have it ...
MIN_DOCS = 10
#: ... and the documents' classes are at least this share of them, so that copies don't count as many.
MIN_VARIETY = 0.5
#: A document that keeps a smaller share of its words is depleted.
MIN_KEPT = 0.2

_HAS_WORD = r"[^\x20\x09-\x0D]"


def _repeat_words(w: Column) -> Column:
    """Words in windows of 8 that occur twice or more.  Windows are compared by a 64-bit hash."""
    k = REPEAT_WINDOW

    def covered(h: Column) -> Column:
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda e, j: (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]))
        starts = F.array_sort(F.transform(let(by_hash, twice), lambda e: e["i"]))
        added = let(starts, lambda p: F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(k)), F.lit(k))))
        return F.aggregate(added, F.lit(0), lambda a, x: a + x)

    # windows of 8 as pairs of windows of 4, those as pairs of 2: two hashes a step instead of eight
    pair = lambda n: lambda a: F.zip_with(a, F.slice(a, n + 1, F.greatest(F.size(a) - n, F.lit(1))), lambda x, y: F.xxhash64(x, y))
    by_two = let(F.transform(w, lambda x: F.xxhash64(x)), pair(1))
    hashes = F.slice(let(let(by_two, pair(2)), pair(4)), F.lit(1), F.size(w) - (k - 1))
    return F.when(F.size(w) > k, let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))).otherwise(F.lit(0))


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the base figures ``n_words`` .. ``base_failed``; map only."""
    t = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("__w", words(F.col("text")))
    w = F.col("__w")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(_HAS_WORD))
    return (out
            .withColumn("n_words", F.size(w).cast("long"))
            .withColumn("word_chars", F.length(F.regexp_replace(t, WS, "")).cast("long"))
            .withColumn("n_symbols", F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long"))
            .withColumn("n_dup_lines", let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
            .withColumn("n_repeat_words", _repeat_words(w).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
            .drop("__w"))


def _lines(text: Column) -> Column:
    """The normalised lines of the text, empty ones too."""
    norm = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09\x0B-\x0D]+", " "), "[0-9]+", "0")
    return F.transform(F.split(norm, "\n", -1), lambda x: F.trim(x))


def _hashes(text: Column, host: Column) -> Column:
    """A hash of host and normalised line for each line of the text; NULL for lines without a word."""
    return F.transform(_lines(text), lambda y: F.when(y != "", F.xxhash64(host, y)))


def _pairs(line: Column, host: Column) -> Column:
    """Hashes of host and word pair of a normalised line (of its word, if it has but one)."""
    return let(F.split(line, " "), lambda w: F.array_distinct(F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(1))), F.slice(w, 2, F.size(w)), lambda x, y: F.xxhash64(host, x, y))))


def boilerplate_lines(docs: DataFrame) -> DataFrame:
    """Hashes ``h`` (host and line) of the lines to remove; materialised."""
    host = F.col("source")
    hashes = docs.select(F.array_distinct(F.array_compact(_hashes(F.col("text"), host))).alias("lines"))
    often = durable(hashes.select(F.explode("lines").alias("h")).groupBy("h").agg(F.count("*").alias("n"))
                    .where(F.col("n") >= MIN_DOCS).select("h"))
    bits = bitmap(often, "h")
    known = maybe_broadcast(often.withColumn("known", F.lit(True)), 16)
    lines = docs.select(F.xxhash64("text", "source").alias("doc"), "source", F.array_distinct(F.transform(
        F.filter(_lines(F.col("text")), lambda y: y != ""), lambda y: F.struct(F.xxhash64(host, y).alias("h"), y.alias("y")))).alias("lines"))
    # the word pairs of the counted lines
    counted = (lines.select("source", F.explode(F.filter("lines", lambda x: in_bitmap(x["h"], bits))).alias("x"))
               .select("source", "x.h", "x.y").join(known, "h", "left_semi").groupBy("h").agg(F.first("source").alias("source"), F.first("y").alias("y")))
    pairs = durable(counted.select(F.explode(_pairs(F.col("y"), host)).alias("pair")).distinct())
    pair_bits = bitmap(pairs, "pair")
    # the lines of documents with a counted line; word pairs go on only of lines that may be edits
    rows = (lines.where(F.exists("lines", lambda x: in_bitmap(x["h"], bits))).select("doc", "source", F.explode("lines").alias("x"))
            .select("doc", "source", "x.h", "x.y").join(known, "h", "left")
            .select("doc", "h", "known", F.when(F.col("known").isNull(), _pairs(F.col("y"), host)).alias("pairs"))
            .withColumn("edit", F.when(2 * F.size(F.filter("pairs", lambda p: in_bitmap(p, pair_bits))) >= F.size("pairs"), F.col("pairs")))
            .select("doc", "h", "known", F.array_min("pairs").alias("least"), F.explode_outer("edit").alias("pair"))
            .join(maybe_broadcast(pairs.withColumn("hit", F.lit(1)), 16), "pair", "left"))
    per_line = rows.groupBy("doc", "h").agg(F.first("known").alias("known"), F.first("least").alias("least"),
                                            F.count("pair").alias("pairs"), F.count("hit").alias("hits"))
    own = F.col("known").isNull() & ((F.col("pairs") == 0) | (2 * F.col("hits") < F.col("pairs")))
    per_doc = (per_line.groupBy("doc").agg(F.min(F.when(own, F.col("least"))).alias("own"),
                                           F.sort_array(F.collect_list(F.when(F.col("known"), F.col("h")))).alias("lines"))
               .select("own", F.slice("lines", 1, 3).alias("first"), F.explode("lines").alias("h")))
    others = F.xxhash64(F.slice(F.array_remove("first", F.col("h")), 1, 2))
    per_class = (per_doc.select("h", F.col("own").isNotNull().alias("own"), F.coalesce("own", others).alias("class"))
                 .groupBy("h", "own", "class").agg(F.count("*").alias("n")))
    count = lambda c: (F.sum(F.when(c, F.col("n"))), F.count(F.when(c, 1)))
    varied = lambda n, m: F.coalesce((m >= MIN_DOCS) & (m >= MIN_VARIETY * n), F.lit(False))
    return durable(per_class.groupBy("h").agg((varied(*count(F.col("own"))) | varied(*count(F.lit(True)))).alias("bad"))
                   .where("bad").select("h"))


def _candidates(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """``docs`` with ``__at``: (hash, place, words) of the lines that may have to go."""
    bits = bitmap(bad, "h")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    at = F.filter(F.transform(_hashes(F.col("text"), F.col("source")), lambda h, i: F.when(
        in_bitmap(h, bits), F.struct(h.alias("h"), i.alias("i")))), lambda x: x.isNotNull())
    return docs.withColumn("__at", let(at, lambda a: F.when(F.size(a) > 0, let(lines, lambda x: F.transform(a, lambda c: F.struct(
        c["h"].alias("h"), c["i"].alias("i"), F.size(words(F.get(x, c["i"]))).alias("n"))))))
                           ).withColumn("__row", F.monotonically_increasing_id())


def _removed(rows: DataFrame, bad: DataFrame, keep: list[Column]) -> DataFrame:
    """``rows`` (one per document and candidate line, ``__line`` NULL if there is none) by document: words and places to remove."""
    known = rows.withColumn("h", F.col("__line.h")).join(maybe_broadcast(bad.withColumn("__bad", F.lit(True)), 24), "h", "left")
    return known.groupBy("__row").agg(
        *keep, F.coalesce(F.sum(F.when(F.col("__bad"), F.col("__line.n"))), F.lit(0)).cast("long").alias("__gone"),
        F.collect_list(F.when(F.col("__bad"), F.col("__line.i"))).alias("__places"))


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _verdict() -> Column:
    return ~F.col("base_failed") & (F.col("n_words") - F.col("__gone") >= MIN_KEPT * F.col("n_words"))


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: the base figures, ``kept``, and the words that removed lines leave."""
    docs = docs.select("doc_id", "text", "source")
    bad = boilerplate_lines(docs)
    figures = F.struct("doc_id", *FIGURES)
    rows = (_candidates(base_rules(docs), bad).select("__row", figures.alias("__own"), F.explode_outer("__at").alias("__line")))
    judged = _removed(rows, bad, [F.first("__own").alias("__own")]).select("__own.*", "__gone")
    return judged.select("doc_id", *FIGURES, _verdict().alias("kept"), (F.col("n_words") - F.col("__gone")).alias("words_left"))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, without the removed lines; the columns of ``docs``.

    Documents without a candidate line go straight through; the others are put together again after the join.
    """
    bad = boilerplate_lines(docs.select("doc_id", "text", "source"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = _candidates(docs.select("text", "source", own.alias("__own")), bad)
    fine = base_rules(found.where(F.col("__at").isNull())).where(~F.col("base_failed")).select("__own.*")
    rows = (found.where(F.col("__at").isNotNull()).select("__row", "__own", F.posexplode("__at").alias("__k", "__line"))
            .select("__row", F.when(F.col("__k") == 0, F.col("__own")).alias("__own"), "__line"))
    text = F.col("__own.text")
    rest = _removed(rows, bad, [F.first("__own", ignorenulls=True).alias("__own")])
    kept = base_rules(rest.withColumn("text", text)).where(_verdict())
    changed = F.size("__places") > 0
    clean = let(F.col("__places"), lambda gone: F.array_join(F.transform(F.filter(
        F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        lambda s: ~F.array_contains(gone, s["i"])), lambda s: s["x"]), "\n"))
    fixed = {"text": F.when(changed, clean).otherwise(text)}
    if "n_chars" in docs.columns:
        fixed["n_chars"] = F.when(changed, F.length(clean).cast("long")).otherwise(F.col("__own.n_chars"))
    return fine.unionByName(kept.select(*[fixed.get(c, F.col(f"__own.`{c}`")).alias(c) for c in docs.columns]))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))

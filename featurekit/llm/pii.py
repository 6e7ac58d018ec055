"""PII: candidates, boosted trees, calibrated thresholds.

Base spans are found by the strict patterns and checks (e-mail, IPv4, card with Luhn, phone).  Besides
them, high-recall generators propose overlapping candidates: obfuscated addresses, dotted and colon-separated
numbers, and digit groups of any punctuation.  Boosted trees score a candidate by its format and its context
(cue words, neighbouring characters), never by the strict checks themselves.  They are fitted on weak labels (does
a candidate pass a strict check once it is normalised: "(at)" and "(dot)" undone, separators dropped or unified?)
of all candidates, one half of them by hash; equal ones are a row with a weight.  Those of the other half that touch no base span, which
are what may be added, calibrate, per generator, the least score down to which candidates are labelled ``PRECISION`` of the time; where
there are few of them the trees' own estimates count for ``PRIOR`` more.  Candidates above it that touch no base span are added.

The fitted trees become one CASE expression, so documents are scored inside their row: no shuffle, no
Python.  Trees need both labels; with one label all candidates have the same score.  NULL and empty texts have no spans;
repeated rows come out repeated.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import apart_from, durable, let, marked_apart, match_spans, table, whole_row

KINDS = ["email", "ip", "card", "phone", "address", "dotted", "digits"]
BASE = 4

# A match starts where a run of its characters does, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Groups of a dotted or colon-separated number: as many as addresses have, 8 at most.
GENERATORS = [
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| \. | ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]++)++",
    r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,5}+(?:\.[0-9]{1,5}+){2,7}|[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{0,4}+){3,7})",
    r"(?<![0-9])[+(]{0,2}[0-9](?:[\x20()./-]{0,2}+[0-9]){5,}+",
]
CUES = ["mail|contact|write", "call|tel|phone|fax|mobile", "card|visa|credit|pay", "ip|host|server|addr", "id|ref|no|order|version"]
CONTEXT = 24
FEATURES = ["generator", "length", "digits", "letters", "separators", "groups", "longest", "distinct", "plus", "paren", "dots", "colons", "at",
            "before_word", "after_word", "before_space", "after_space", "same_digit"] + [f"cue{i}" for i in range(len(CUES))]

PRECISION = 0.9
#: Candidates that the trees' own estimate counts for beside those that calibrate a threshold.
PRIOR = 5.0
BINS = 50
ROUNDS, DEPTH, SEED = 10, 3, 5


def _luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
            F.ascii(d) - 48, lambda v: F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v))),
        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _is_card(m: Column) -> Column:
    return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))


def _is_ip(m: Column) -> Column:
    part = lambda p: let(F.regexp_replace(p, "^0+", ""), lambda x: (F.length(x) == 0) | F.when(
        F.length(x) <= 3, x.cast("int") <= 255).otherwise(F.lit(False)))
    return F.forall(F.split(m, r"\."), part)


def _base(t: Column) -> Column:
    tag = lambda spans, k: F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
    return F.array_sort(F.concat(
        tag(match_spans(t, EMAIL), 0), tag(match_spans(t, IP, _is_ip), 1), tag(match_spans(t, CARD, _is_card), 2),
        tag(match_spans(t, PHONE, lambda m: F.length(_digits(m)).between(9, 15)), 3)))


def _features(t: Column, g: int, s: Column, e: Column) -> Column:
    """Format and context of the candidate ``t[s:e]``, in the order of FEATURES, as doubles."""
    def of(x: Column) -> Column:
        m, before, after = x["m"], x["b"], x["a"]
        count = lambda pattern: F.length(F.regexp_replace(m, pattern, ""))
        parts = F.split(m, "[^0-9A-Za-z]+")
        digit = F.split(_digits(m), "")
        flag = lambda c: c.cast("int")
        values = [F.lit(g), F.length(m), count("[^0-9]"), count("[^A-Za-z]"), count("[0-9A-Za-z]"), F.size(parts),
                  F.array_max(F.transform(parts, lambda p: F.length(p))), F.size(F.array_distinct(digit)),
                  flag(m.startswith("+")), flag(m.contains("(")), count("[^.]"), count("[^:]"), flag(m.contains("@")),
                  flag(before.rlike(r"[\p{L}\p{N}]$")), flag(after.rlike(r"^[\p{L}\p{N}]")), flag(before.rlike(r"(^|\s)$")),
                  flag(after.rlike(r"^(\s|$)")), flag(m.rlike(r"([0-9])\1{5}")),
                  *[flag(before.rlike(f"(?i)\\b(?:{c})\\b")) for c in CUES]]
        return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])

    start = F.greatest(s - CONTEXT, F.lit(0))
    return let(F.struct(F.substring(t, s + 1, e - s).alias("m"), F.substring(t, start + 1, s - start).alias("b"),
                        F.substring(t, e + 1, F.lit(4)).alias("a")), of)


def _personal(m: Column, g: int) -> Column:
    """The weak label: does the candidate pass a strict check in its normalised form?"""
    if g == 0:
        plain = F.regexp_replace(F.regexp_replace(m, r"\x20?(?:\(at\)|\[at\])\x20?|\x20@\x20", "@"), r"\x20?(?:\(dot\)|\[dot\])\x20?|\x20\.\x20", ".")
        return plain.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z][A-Za-z0-9-]+$")
    if g == 1:
        dotted = F.translate(m, ":", ".")
        ip = F.when(dotted.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), _is_ip(dotted)).otherwise(F.lit(False))
        hardware = m.rlike("^[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}$")
        long = m.rlike("^[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}$") | (m.rlike("^[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4})+$") & m.rlike(
            "^[^:]+(?::[^:]+)*::(?:[^:]+(?::[^:]+)*)?$"))
        return ip | hardware | long
    phone = m.rlike(r"^\(?\+|^00[1-9]|^\([0-9]{2,5}\)") & F.length(F.regexp_replace(_digits(m), "^00", "")).between(9, 15)
    return _is_card(m) | phone


def _places(t: Column, g: int) -> Column:
    """Spans of a generator, as ``array<struct<s,e,k>>``."""
    return F.transform(match_spans(t, GENERATORS[g]), lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.lit(BASE + g).alias("k")))


def _candidates(t: Column, base: Column) -> Column:
    """``array<struct<s,k,e,f>>``: spans that overlap no base span, generator and features."""
    def of(g: int):       # a lambda's second parameter would be the index
        return lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"), _features(t, g, c["s"], c["e"]).alias("f"))

    return F.concat(*[F.transform(apart_from(_places(t, g), base), of(g)) for g in range(len(GENERATORS))])


def _tree(node, f: Column) -> Column:
    """A fitted regression tree as a CASE expression over the feature array."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return (F.when(F.get(f, F.lit(split.featureIndex())) <= float(split.threshold()), _tree(node.leftChild(), f))
            .otherwise(_tree(node.rightChild(), f)))


class PiiModel:
    """Boosted trees as a Column, and the calibrated threshold of each generator."""

    def __init__(self, trees: list | None = None, weights: list | None = None, thresholds: dict[int, float] | None = None):
        self.trees, self.weights, self.thresholds = trees or [], weights or [], thresholds or {}

    def score(self, f: Column) -> Column:
        margin = F.lit(0.0)
        for node, w in zip(self.trees, self.weights, strict=True):
            margin = margin + _tree(node, f) * float(w)
        return 1 / (1 + F.exp(-2 * margin))

    def accepts(self, c: Column) -> Column:
        if not self.thresholds:
            return F.lit(False)
        least = F.lit(None).cast("double")
        for k, v in sorted(self.thresholds.items()):
            least = F.when(c["k"] == k, F.lit(v)).otherwise(least)
        return F.coalesce(self.score(c["f"]) >= least, F.lit(False))


def fit(docs: DataFrame) -> PiiModel:
    """Fit on the weak labels of all candidates, half of them (by hash) for the trees and half for the thresholds.

    Candidates of equal features and label are one row that weighs as much as there are of them.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", t.alias("t")).withColumn("base", _base(F.col("t")))
    places = F.array_sort(F.concat(*[_places(F.col("t"), g) for g in range(len(GENERATORS))]))
    own = (rows.select("doc_id", "t", F.explode(marked_apart(places, F.col("base"))).alias("m"))
           .select("doc_id", "t", F.struct("m.x.*", (~F.col("m.apart")).alias("y")).alias("c"))
           .withColumn("h", F.xxhash64("doc_id", "c.s", "c.k", F.lit(SEED))))
    s, e, k = F.col("c.s"), F.col("c.e"), F.col("c.k")
    m = F.substring(F.col("t"), s + 1, e - s)
    feature, label = F.lit(None).cast("array<double>"), F.lit(None).cast("boolean")
    for g in range(len(GENERATORS)):
        feature = F.when(k == BASE + g, _features(F.col("t"), g, s, e)).otherwise(feature)
        label = F.when(k == BASE + g, _personal(m, g)).otherwise(label)
    alike = ["k", "y", "half", "label", "f"]
    kinds = own.select(k.alias("k"), F.col("c.y").alias("y"), F.pmod(F.shiftright("h", 32), F.lit(2)).alias("half"),
                       F.coalesce(label, F.lit(False)).cast("int").alias("label"), feature.alias("f")).groupBy(*alike).agg(F.count("*").alias("n"))
    kinds = durable(kinds.sortWithinPartitions(*alike).select("*", *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(FEATURES)]))
    use = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(kinds)
    train = use.where("half = 0").select("features", F.col("label").cast("double").alias("label"), F.col("n").cast("double").alias("n"))
    labels = [r["label"] for r in train.select("label").distinct().collect()]
    if not labels:
        return PiiModel()
    model, alone = PiiModel(), labels[0] if len(labels) == 1 else None
    if alone is None:
        fitted = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED, weightCol="n").fit(train)
        model = PiiModel([tree._call_java("rootNode") for tree in fitted.trees], fitted.treeWeights)
    bins = (kinds.where("half <> 0 and not y").withColumn("score", model.score(F.col("f"))).groupBy("k", F.floor(F.col("score") * BINS).alias("bin"))
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("p")).collect())        # BINS + 1 rows a generator
    for k in range(BASE, BASE + len(GENERATORS)):
        model.thresholds[k] = threshold({r["bin"]: (r["n"], r["p"]) for r in bins if r["k"] == k}, alone)
    return model


def threshold(bins: dict[int, tuple[int, int]], alike: float | None = None) -> float:
    """The least score down to which candidates are labelled PRECISION of the time, going down bin by bin.

    ``bins``: candidates and labelled ones by score.  A bin counts with PRIOR candidates more that are labelled as often as
    its score says (as ``alike``, where there are no trees because all labels are), so few candidates lean on the trees, and many on what was counted.
    """
    least = 1.01
    for bin_ in range(BINS, -1, -1):
        n, p = bins.get(bin_, (0, 0))
        expected = min(1.0, (bin_ + 0.5) / BINS) if alike is None else alike
        if p + PRIOR * expected < PRECISION * (n + PRIOR):
            break
        least = bin_ / BINS
    return least


def with_spans(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``__doc`` (the row), ``__base`` and ``__spans``: ``array<struct<s,k,e>>`` by start, then kind."""
    t = F.coalesce(F.col("__t"), F.lit(""))
    out = docs.select(whole_row(docs), F.col("text").alias("__t")).withColumn("__base", _base(t))
    if not model.thresholds:
        return out.withColumn("__spans", F.col("__base"))
    more = F.transform(F.filter(_candidates(t, F.col("__base")), model.accepts),
                       lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e")))
    return out.withColumn("__spans", F.array_sort(F.concat("__base", more)))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as text."""
    docs = docs.select("doc_id", "text")
    count = lambda k: F.size(F.filter("__base", lambda x: x["k"] == k)).cast("long")
    return with_spans(docs, fit(docs)).select(
        "__doc.doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(_text(F.col("__base")), 256).alias("base_sha256"), _text(F.col("__spans")).alias("spans"))


def op4_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))

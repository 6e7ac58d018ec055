"""Registered queries: one per operator of the inventory, each over whole given tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL over the same tables,
registered as views) compute the same rows with the same column names; floats are rounded to 6
places in both.  Queries without an SQL form (stability scan, halving search) have no oracle entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.contracts import col
from featurekit.functions.stats import round6
from featurekit.operators import (CorrelationPruner, DropColumns, KeepColumns, KnnClassifier, KnnImpute,
                                  OneHot, RobustScale, SigmaClip, TargetEncode, TukeyClip, ValueMapper,
                                  correlation_pairs, mapping_coverage)
from featurekit.operators.correlation import pruning_decisions
from featurekit.plans import evaluate as ev
from featurekit.plans import split as sp
from featurekit.plans.recipes import (customer_like_recipe, customer_setup, homerun_like_recipe, passenger_like_recipe,
                                      passenger_setup)
from featurekit.sources import tables as src

# Fixed values of the fixtures (FIXTURES.md): mappings, thresholds, seeds.
PRIORITY_MAP = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3}
COVERAGE_MAP = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "X-NONE": 9}
SWAP_MAP = {"A": "R", "R": "A"}
THRESHOLDS_19 = [i / 18.0 for i in range(19)]
THRESHOLDS_21 = [i / 20.0 for i in range(21)]
SPLIT_SEED = 107
SCAN_SEEDS = range(200)        # of the stability scan, as split_stability takes by default

R6 = round6


def _r6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[R6(col(c)).alias(c) if c in cols else col(c) for c in df.columns])


# ---------------------------------------------------------------- O1, O2 value mapping
def map_priority(spark: SparkSession, d: str) -> DataFrame:
    o = src.read(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return ValueMapper("o_orderpriority", PRIORITY_MAP).transform(o)


def map_swap(spark, d):
    li = src.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return ValueMapper("l_returnflag", SWAP_MAP).transform(li)


def map_coverage(spark, d):
    o = src.read(spark, d, "orders")
    return mapping_coverage(o, "o_orderpriority", COVERAGE_MAP)


# ---------------------------------------------------------------- O3 one-hot
def onehot_event(spark, d):
    e = src.read(spark, d, "events")
    e = e.select("event_id", src.missing("event_id", 11, F.col("event_type")).alias("event_type"),
                 R6(F.col("value")).alias("value"))
    return OneHot("event_type").transform(e)


# ---------------------------------------------------------------- O4, O5 drop / keep
def drop_cols(spark, d):
    return DropColumns(["p_name", "p_type", "not_a_column"]).transform(src.read(spark, d, "part"))


def keep_cols(spark, d):
    return KeepColumns(["p_retailprice", "p_partkey", "p_size"]).transform(src.read(spark, d, "part"))


# ---------------------------------------------------------------- O6, O7 correlation
def _lineitem_numeric(spark, d):
    li = src.read(spark, d, "lineitem")
    return li.select(
        "l_quantity", "l_extendedprice",
        src.missing("l_orderkey", 5, F.col("l_discount")).alias("l_discount"),
        "l_tax",
        (F.col("l_extendedprice") * 2 + F.col("l_tax")).alias("near_copy"),
        F.lit(1.0).alias("constant"))


def pearson_pairs(spark, d):
    return _r6(correlation_pairs(_lineitem_numeric(spark, d)), ["corr"])


def pearson_prune(spark, d):
    return pruning_decisions(_lineitem_numeric(spark, d), 0.9)


def pearson_prune_apply(spark, d):
    """The pruner itself, with keys and a label that it neither compares nor drops."""
    li = src.read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax",
        (F.col("l_extendedprice") * 2 + F.col("l_tax")).alias("near_copy"), (F.col("l_extendedprice") * 3).alias("label"))
    return _r6(CorrelationPruner(0.9, keep=["l_orderkey", "l_linenumber", "label"]).fit_transform(li),
               ["l_extendedprice", "label"])


# ---------------------------------------------------------------- O8-O11 clipping and scaling
def sigma3_value(spark, d):
    e = src.read(spark, d, "events").select("event_id", "value")
    return _r6(SigmaClip("value").fit_transform(e), ["value"])


def sigma3_missing(spark, d):
    c = src.read(spark, d, "customer")
    c = c.select("c_custkey", src.missing("c_custkey", 5, F.col("c_acctbal")).alias("c_acctbal"))
    return _r6(SigmaClip("c_acctbal").fit_transform(c), ["c_acctbal"])


def tukey_inner(spark, d):
    e = src.read(spark, d, "events").select("event_id", "value")
    return _r6(TukeyClip("value", "inner").fit_transform(e), ["value"])


def tukey_outer(spark, d):
    e = src.read(spark, d, "events").select("event_id", "value")
    return _r6(TukeyClip("value", "outer").fit_transform(e), ["value"])


def tukey_outer_docs(spark, d):
    doc = src.read(spark, d, "documents").select("doc_id", "n_chars")
    return _r6(TukeyClip("n_chars", "outer").fit_transform(doc), ["n_chars"])


def robust_price(spark, d):
    li = src.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return _r6(RobustScale("l_extendedprice").fit_transform(li), ["l_extendedprice"])


def robust_const(spark, d):
    r = src.read(spark, d, "orders").select("o_orderkey", F.lit(1).alias("constant"))
    return RobustScale("constant").fit_transform(r)


# ---------------------------------------------------------------- O12, O13 KNN imputation
def knn_impute_uniform(spark, d):
    p = src.parts_with_gaps(spark, d)
    return _r6(KnnImpute("p_partkey", k=5).fit_transform(p), ["p_size", "p_retailprice"])


def knn_impute_distance(spark, d):
    p = src.parts_with_gaps(spark, d)
    return _r6(KnnImpute("p_partkey", k=5, weights="distance").fit_transform(p), ["p_size", "p_retailprice"])


def knn_align(spark, d):
    p = src.parts_with_gaps(spark, d)
    model = KnnImpute("p_partkey", k=5).fit(p)
    other = p.drop("p_size").withColumn("extra", F.lit(1.0))
    return _r6(model.transform(other), ["p_size", "p_retailprice"])


def knn_impute_wide(spark, d):
    pts = src.wide_gaps(spark, d)
    return _r6(KnnImpute("vec_id", k=5).fit_transform(pts), pts.columns[1:])


# ---------------------------------------------------------------- O14 target encoding
def target_segment(spark, d):
    o = src.read(spark, d, "orders")
    c = src.read(spark, d, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey", "c_mktsegment", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("y"))
    return _r6(TargetEncode("c_mktsegment", "y", 10.0).fit_transform(j), ["c_mktsegment"])


def target_source_null(spark, d):
    docs = src.documents_with_labels(spark, d)
    return _r6(TargetEncode("source", "quality", 15.0).fit_transform(docs).select("doc_id", "source", "quality"),
               ["source"])


# ---------------------------------------------------------------- O16, O21, O17 split / sample / prepare
def split_rows(spark, d):
    lab = src.read(spark, d, "labels").select("doc_id", "toxic")
    return sp.split_membership(lab, "toxic", "doc_id", 0.2, SPLIT_SEED)


def split_sizes(spark, d):
    return split_rows(spark, d).groupBy("toxic", "is_test").agg(F.count(F.lit(1)).alias("n"))


def downsample_quality(spark, d):
    lab = src.read(spark, d, "labels").select("doc_id", "quality")
    return sp.downsample(lab, "quality", "doc_id", 1.0, SPLIT_SEED)


def prepare_fit_on_train(spark, d):
    from featurekit.plans.chain import FeatureChain

    docs = src.scored_documents(spark, d).select("doc_id", "toxic", F.col("n_chars").cast("double").alias("n_chars"))
    chain = FeatureChain([TukeyClip("n_chars", "outer"), RobustScale("n_chars")])
    train, test, _ = sp.prepare(docs, "toxic", chain, "doc_id", SPLIT_SEED, 0.2)
    out = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return _r6(out, ["n_chars"])


# ---------------------------------------------------------------- O22-O25 evaluation
def confusion_at_half(spark, d):
    s = src.scored_documents(spark, d)
    return _r6(ev.confusion(s, "quality", "score", 0.5), ["precision", "recall", "f1", "accuracy"])


def auc(spark, d):
    return _r6(ev.roc_auc(src.scored_documents(spark, d), "quality", "score"), ["auc"])


def auc_by_lang(spark, d):
    return _r6(ev.roc_auc(src.scored_documents(spark, d), "quality", "score", ["lang"]), ["auc"])


def threshold_sweep(spark, d):
    return ev.threshold_sweep(src.scored_documents(spark, d), THRESHOLDS_19, "quality", "score")


def threshold_sweep_by_lang(spark, d):
    return ev.threshold_sweep(src.scored_documents(spark, d), THRESHOLDS_21, "quality", "score", ["lang"])


def best_flags(spark, d):
    sweep = ev.threshold_sweep(src.scored_documents(spark, d), THRESHOLDS_19, "quality", "score")
    return ev.best_flags(sweep)


# ---------------------------------------------------------------- O27 KNN classification
def knn_classify(spark, d):
    pts = src.embedding_points(spark, d)
    model = KnnClassifier("vec_id", "y", k=5).fit(pts)
    return model.transform(pts).select("vec_id", "y", "prediction")


QUERIES = {
    "map_priority": map_priority,
    "map_swap": map_swap,
    "map_coverage": map_coverage,
    "onehot_event": onehot_event,
    "drop_cols": drop_cols,
    "keep_cols": keep_cols,
    "pearson_pairs": pearson_pairs,
    "pearson_prune": pearson_prune,
    "pearson_prune_apply": pearson_prune_apply,
    "sigma3_value": sigma3_value,
    "sigma3_missing": sigma3_missing,
    "tukey_inner": tukey_inner,
    "tukey_outer": tukey_outer,
    "tukey_outer_docs": tukey_outer_docs,
    "robust_price": robust_price,
    "robust_const": robust_const,
    "knn_impute_uniform": knn_impute_uniform,
    "knn_impute_distance": knn_impute_distance,
    "knn_align": knn_align,
    "knn_impute_wide": knn_impute_wide,
    "target_segment": target_segment,
    "target_source_null": target_source_null,
    "split_rows": split_rows,
    "split_sizes": split_sizes,
    "downsample": downsample_quality,
    "prepare_fit_on_train": prepare_fit_on_train,
    "confusion": confusion_at_half,
    "auc": auc,
    "auc_by_lang": auc_by_lang,
    "threshold_sweep": threshold_sweep,
    "threshold_sweep_by_lang": threshold_sweep_by_lang,
    "best_flags": best_flags,
    "knn_classify": knn_classify,
}


# ---------------------------------------------------------------- flagship (entry)
def flagship(spark, d):
    """Recipe A's shape prepared on orders x customer, then the sweep of the segment encoding as a
    score over the prepared test rows."""
    df = src.passenger_like(spark, d)
    _, test, _ = sp.prepare(df, "y", passenger_like_recipe(), "o_orderkey", SPLIT_SEED, 0.2)
    return ev.threshold_sweep(test, THRESHOLDS_19, "y", "port")


# ---------------------------------------------------------------- O18-O20 recipes, O26, O28
def _both_sides(train, test):
    out = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return _r6(out, [c for c, t in out.dtypes if t == "double"])


def recipe_a(spark, d):
    train, test, _ = passenger_setup(src.passenger_like(spark, d), "o_orderkey", passenger_like_recipe(), "y")
    return _both_sides(train, test)


def recipe_b(spark, d):
    train, test, _ = customer_setup(src.customer_like(spark, d), "event_id", customer_like_recipe(), "y")
    return _both_sides(train, test)


def recipe_c(spark, d):
    train, test, _ = sp.prepare(src.homerun_like(spark, d), "y", homerun_like_recipe(), "doc_id", SPLIT_SEED, 0.2)
    return _both_sides(train, test)


def split_scan(spark, d):
    from featurekit.plans.search import split_stability

    best, res = split_stability(src.homerun_like(spark, d), "y", "doc_id", homerun_like_recipe(), seeds=SCAN_SEEDS)
    return _r6(res.withColumn("chosen", F.col("seed") == F.lit(best)), ["train_f1", "test_f1", "ratio"])


def halving(spark, d):
    from featurekit.plans.search import halving_logistic

    s = src.scored_documents(spark, d).select("doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"),
                                              "score")
    grid = {"regParam": [0.0, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5]}
    res, _, _ = halving_logistic(s, "quality", "doc_id", ["n_chars", "score"], grid)
    return _r6(res, ["mean_score", "std_score"])


QUERIES.update({
    "recipe_a": recipe_a,
    "recipe_b": recipe_b,
    "recipe_c": recipe_c,
    "split_scan": split_scan,
    "halving": halving,
})

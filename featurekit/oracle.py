"""DuckDB SQL equivalents of the registered queries (tables are pre-registered views).

Built from the same fixed values as ``featurekit.catalogue``; floats rounded to 6 places, sweep
columns with ``round_even(x * 100, 0) / 100`` (numpy's rule).
"""

from __future__ import annotations

from featurekit import catalogue as cat
from featurekit.plans import recipes as rec
from featurekit.sources import tables as src


def _case_map(expr: str, mapping: dict, else_sql: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN {v!r}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {else_sql} END"


def _split_cte(base: str, label: str, key: str, seed: int, ts: float, name: str = "split") -> str:
    """CTE producing ``{name}`` = base columns + is_test, by the exact rule of plans.split."""
    return f"""
 {name}_c AS (SELECT {label} AS y, count(*) AS n FROM {base} GROUP BY 1),
 {name}_t AS (SELECT sum(n) AS n, sum(n) - CAST(ceil({ts} * sum(n)) AS BIGINT) AS ntrain FROM {name}_c),
 {name}_a0 AS (SELECT c.y, c.n, (c.n * t.ntrain) // t.n AS base, (c.n * t.ntrain) % t.n AS rem, t.ntrain
               FROM {name}_c c, {name}_t t),
 {name}_a AS (SELECT y, n, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, y) <= ntrain - sum(base) OVER ()
               THEN 1 ELSE 0 END AS train_c FROM {name}_a0),
 {name}_r AS (SELECT b.*, row_number() OVER (PARTITION BY b.{label}
               ORDER BY md5(concat_ws('|', b.{key}, {seed})), b.{key}) AS rn FROM {base} b),
 {name} AS (SELECT r.* EXCLUDE (rn), r.rn <= a.n - a.train_c AS is_test FROM {name}_r r JOIN {name}_a a ON r.{label} = a.y)"""


def _knn_impute_sql(points: str, queries: str, weights: str, k: int = 5) -> str:
    """points: (k, f0, f1) fit rows; queries: (k, f0, f1) rows to fill.  Output p_partkey, p_size, p_retailprice."""
    if weights == "uniform":
        agg = "avg(v)"
    else:
        agg = ("CASE WHEN min(dist) = 0 THEN avg(CASE WHEN dist = 0 THEN v END) "
               "ELSE sum(v / nullif(dist, 0)) / sum(1.0::DOUBLE / nullif(dist, 0)) END")
    both0 = "q.f0 IS NOT NULL AND d.f0 IS NOT NULL"
    both1 = "q.f1 IS NOT NULL AND d.f1 IS NOT NULL"
    return f"""
WITH p AS ({points}),
 qq AS ({queries}),
 means AS (SELECT avg(f0) AS m0, avg(f1) AS m1 FROM p),
 q AS (SELECT k, 0 AS t, f0, f1 FROM qq WHERE f0 IS NULL UNION ALL SELECT k, 1 AS t, f0, f1 FROM qq WHERE f1 IS NULL),
 pairs AS (SELECT q.k AS qk, q.t, d.k AS dk,
     (CASE WHEN {both0} THEN 1 ELSE 0 END) + (CASE WHEN {both1} THEN 1 ELSE 0 END) AS nc,
     (CASE WHEN {both0} THEN (q.f0 - d.f0) * (q.f0 - d.f0) ELSE 0.0::DOUBLE END)
       + (CASE WHEN {both1} THEN (q.f1 - d.f1) * (q.f1 - d.f1) ELSE 0.0::DOUBLE END) AS ss,
     CASE q.t WHEN 0 THEN d.f0 ELSE d.f1 END AS v
   FROM q, p d),
 ranked AS (SELECT qk, t, v, sqrt(2.0::DOUBLE / nc * ss) AS dist,
     row_number() OVER (PARTITION BY qk, t ORDER BY sqrt(2.0::DOUBLE / nc * ss), dk) AS rn
   FROM pairs WHERE nc > 0 AND v IS NOT NULL),
 imp AS (SELECT qk, t, {agg} AS iv FROM ranked WHERE rn <= {k} GROUP BY qk, t)
SELECT qq.k AS p_partkey, round(coalesce(qq.f0, i0.iv, m0), 6) AS p_size,
       round(coalesce(qq.f1, i1.iv, m1), 6) AS p_retailprice
FROM qq CROSS JOIN means
LEFT JOIN imp i0 ON i0.qk = qq.k AND i0.t = 0
LEFT JOIN imp i1 ON i1.qk = qq.k AND i1.t = 1"""


PARTS = ("SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS f0, "
         "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS f1 FROM part")

SCORED = ("SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars, "
          "least(1.0::DOUBLE, d.n_chars / 2000.0::DOUBLE) AS score FROM labels l JOIN documents d USING (doc_id)")

LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "near_copy", "constant"]
LINEITEM_X = ("SELECT l_quantity AS c0, l_extendedprice AS c1, "
              "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS c2, l_tax AS c3, "
              "l_extendedprice * 2 + l_tax AS c4, 1.0::DOUBLE AS c5 FROM lineitem")


def _pairs_sql() -> str:
    parts = []
    n = len(LINEITEM_NUM)
    for i in range(n):
        for j in range(i + 1, n):
            parts.append(f"SELECT {i} AS i, {j} AS j, '{LINEITEM_NUM[i]}' AS col_i, '{LINEITEM_NUM[j]}' AS col_j, "
                         f"corr(c{i}, c{j}) AS r FROM x")
    return " UNION ALL ".join(parts)


def _rt(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def _metric_sql(tp="tp", fp="fp", tn="tn", fn="fn") -> dict:
    return {
        "precision": f"coalesce({tp} / nullif({tp} + {fp}, 0), 0)",
        "recall": f"coalesce({tp} / nullif({tp} + {fn}, 0), 0)",
        "f1": f"coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0)",
        "accuracy": f"({tp} + {tn}) / nullif({tp} + {fp} + {tn} + {fn}, 0)",
    }


def _sweep_sql(n_points: int, group: str | None) -> str:
    g = f"{group}, " if group else ""
    gsel = f"s.{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    on = f"ON a.{group} = c.{group}" if group else "ON TRUE"
    m = _metric_sql()
    return f"""
WITH s AS ({SCORED}),
 t AS (SELECT i, i::DOUBLE / {float(n_points - 1)}::DOUBLE AS thr FROM range({n_points}) r(i)),
 c AS (SELECT {gsel}t.i, t.thr,
         sum(CASE WHEN s.score >= t.thr AND s.quality = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
         sum(CASE WHEN s.score >= t.thr AND s.quality = 0 THEN 1 ELSE 0 END)::DOUBLE AS fp,
         sum(CASE WHEN s.score < t.thr AND s.quality = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn,
         sum(CASE WHEN s.score < t.thr AND s.quality = 1 THEN 1 ELSE 0 END)::DOUBLE AS fn
       FROM t CROSS JOIN s GROUP BY {gsel}t.i, t.thr),
 h AS (SELECT {g}score, sum(quality)::DOUBLE AS p, sum(1 - quality)::DOUBLE AS n FROM s GROUP BY {g}score),
 b AS (SELECT {g}p, n, coalesce(sum(n) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h),
 a AS (SELECT {g}sum(p * (below + n / 2)) / nullif(sum(p) * sum(n), 0) AS auc FROM b {"GROUP BY " + group if group else ""})
SELECT {"c." + group + ", " if group else ""}{_rt("c.thr")} AS threshold,
  {_rt(m["precision"])} AS precision, {_rt(m["recall"])} AS recall, {_rt(m["f1"])} AS f1,
  {_rt(m["accuracy"])} AS accuracy, {_rt("a.auc")} AS auc
FROM c JOIN a {on}"""


def _auc_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
WITH s AS ({SCORED}),
 h AS (SELECT {g}score, sum(quality)::DOUBLE AS p, sum(1 - quality)::DOUBLE AS n FROM s GROUP BY {g}score),
 b AS (SELECT {g}p, n, coalesce(sum(n) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h)
SELECT {g}round(sum(p * (below + n / 2)) / nullif(sum(p) * sum(n), 0), 6) AS auc FROM b {"GROUP BY " + group if group else ""}"""


def _tukey_sql(table: str, key: str, column: str, w: float) -> str:
    return f"""
WITH q AS (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {table})
SELECT {key}, round(CASE WHEN {column} IS NULL THEN NULL ELSE
  least(greatest(CAST({column} AS DOUBLE), q1 - {w} * (q3 - q1)), q3 + {w} * (q3 - q1)) END, 6) AS {column}
FROM {table}, q"""


def _sigma_sql(table: str, key: str, column: str) -> str:
    return f"""
WITH s AS (SELECT avg({column}) AS m, stddev_samp({column}) AS sd FROM {table})
SELECT {key}, round(CASE WHEN {column} IS NULL THEN NULL ELSE
  least(greatest({column}, m - 3 * sd), m + 3 * sd) END, 6) AS {column}
FROM {table}, s"""


def _target_sql(base: str, key_cols: str, column: str, label: str, m: float, extra: str = "") -> str:
    return f"""
WITH j AS ({base}),
 g AS (SELECT avg({label}) AS gm FROM j),
 c AS (SELECT {column} AS v, count(*) AS n, avg({label}) AS mc FROM j WHERE {column} IS NOT NULL GROUP BY 1)
SELECT {key_cols}, round((c.n * c.mc + {m} * g.gm) / (c.n + {m}), 6) AS {column}{extra}
FROM j LEFT JOIN c ON j.{column} = c.v CROSS JOIN g"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["map_priority"] = (
        "SELECT o_orderkey, CAST(" + _case_map("o_orderpriority", cat.PRIORITY_MAP, "TRY_CAST(o_orderpriority AS BIGINT)")
        + " AS BIGINT) AS o_orderpriority FROM orders")
    sql["map_swap"] = ("SELECT l_orderkey, l_linenumber, l_quantity, "
                       + _case_map("l_returnflag", cat.SWAP_MAP, "l_returnflag") + " AS l_returnflag FROM lineitem")
    keys = ", ".join(f"('{k}')" for k in cat.COVERAGE_MAP)
    sql["map_coverage"] = f"""
SELECT value, 'key_not_in_data' AS side FROM (SELECT * FROM (VALUES {keys}) k(value) EXCEPT SELECT o_orderpriority FROM orders)
UNION ALL
SELECT value, 'value_without_key' AS side FROM (SELECT o_orderpriority AS value FROM orders EXCEPT SELECT * FROM (VALUES {keys}) k(value))"""
    cats = ["click", "error", "purchase", "signup", "view"]
    sql["onehot_event"] = ("SELECT event_id, value, " + ", ".join(
        f"coalesce(CAST(et = '{c}' AS INTEGER), 0) AS event_type_{c}" for c in cats)
        + " FROM (SELECT event_id, round(value, 6) AS value, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS et FROM events)")
    sql["drop_cols"] = "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part"
    sql["keep_cols"] = "SELECT p_retailprice, p_partkey, p_size FROM part"
    sql["pearson_pairs"] = (f"WITH x AS ({LINEITEM_X}) SELECT i, j, col_i, col_j, "
                            f"round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS corr FROM ({_pairs_sql()})")
    names = ", ".join(f"({k}, '{c}')" for k, c in enumerate(LINEITEM_NUM))
    sql["pearson_prune"] = f"""
WITH x AS ({LINEITEM_X}), p AS (SELECT j, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM ({_pairs_sql()}))
SELECT n.col_pos, n.col_name, coalesce(bool_or(abs(p.r) > 0.9), false) AS dropped
FROM (VALUES {names}) n(col_pos, col_name) LEFT JOIN p ON p.j = n.col_pos GROUP BY n.col_pos, n.col_name"""
    sql["pearson_prune_apply"] = """SELECT l_orderkey, l_linenumber, l_quantity, round(l_extendedprice, 6) AS l_extendedprice,
 l_tax, round(l_extendedprice * 3, 6) AS label FROM lineitem"""
    sql["sigma3_value"] = _sigma_sql("events", "event_id", "value")
    sql["sigma3_missing"] = _sigma_sql(
        "(SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer)",
        "c_custkey", "c_acctbal")
    sql["tukey_inner"] = _tukey_sql("events", "event_id", "value", 1.5)
    sql["tukey_outer"] = _tukey_sql("events", "event_id", "value", 3.0)
    sql["tukey_outer_docs"] = _tukey_sql("documents", "doc_id", "n_chars", 3.0)
    sql["robust_price"] = """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS med,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - med) / (q3 - q1), 6) AS l_extendedprice FROM lineitem, q"""
    sql["robust_const"] = """
WITH r AS (SELECT o_orderkey, 1.0::DOUBLE AS c FROM orders),
 q AS (SELECT quantile_cont(c, 0.25) AS q1, quantile_cont(c, 0.5) AS med, quantile_cont(c, 0.75) AS q3 FROM r)
SELECT o_orderkey, CASE WHEN q3 - q1 = 0 THEN c ELSE (c - med) / (q3 - q1) END AS constant FROM r, q"""
    sql["knn_impute_uniform"] = _knn_impute_sql(PARTS, PARTS, "uniform")
    sql["knn_impute_distance"] = _knn_impute_sql(PARTS, PARTS, "distance")
    sql["knn_align"] = _knn_impute_sql(PARTS, "SELECT k, NULL::DOUBLE AS f0, f1 FROM (" + PARTS + ")", "uniform")
    sql["target_segment"] = _target_sql(
        "SELECT o_orderkey, c_mktsegment, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS y "
        "FROM orders JOIN customer ON o_custkey = c_custkey", "j.o_orderkey", "c_mktsegment", "y", 10.0, ", j.y")
    sql["target_source_null"] = _target_sql(
        "SELECT d.doc_id, d.source, CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE l.quality END AS quality "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id", "j.doc_id", "source", "quality", 15.0,
        ", j.quality")
    split = _split_cte("(SELECT doc_id, toxic FROM labels)", "toxic", "doc_id", cat.SPLIT_SEED, 0.2)
    sql["split_rows"] = f"WITH {split} SELECT doc_id, toxic, is_test FROM split"
    sql["split_sizes"] = f"WITH {split} SELECT toxic, is_test, count(*) AS n FROM split GROUP BY 1, 2"
    sql["downsample"] = f"""
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality
             ORDER BY md5(concat_ws('|', doc_id, {cat.SPLIT_SEED})), doc_id) AS rn FROM labels),
 c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1),
 maj AS (SELECT quality, n FROM c ORDER BY n DESC, CAST(quality AS VARCHAR) DESC LIMIT 1),
 k AS (SELECT least(maj.n, CAST(round(1.0 * (SELECT sum(n) FROM c WHERE quality <> maj.quality)) AS BIGINT)) AS k,
              maj.quality AS mq FROM maj)
SELECT doc_id, quality FROM r, k WHERE r.quality <> k.mq OR r.rn <= k.k"""
    split_d = _split_cte("(SELECT l.doc_id, l.toxic, CAST(d.n_chars AS DOUBLE) AS n_chars FROM labels l "
                         "JOIN documents d ON l.doc_id = d.doc_id)", "toxic", "doc_id", cat.SPLIT_SEED, 0.2)
    sql["prepare_fit_on_train"] = f"""
WITH {split_d},
 tq AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM split WHERE NOT is_test),
 c AS (SELECT s.*, least(greatest(n_chars, q1 - 3.0 * (q3 - q1)), q3 + 3.0 * (q3 - q1)) AS x FROM split s, tq),
 rq AS (SELECT quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.5) AS m, quantile_cont(x, 0.75) AS b FROM c WHERE NOT is_test)
SELECT doc_id, toxic, round((x - m) / (b - a), 6) AS n_chars, is_test FROM c, rq"""
    m = _metric_sql()
    sql["confusion"] = f"""
WITH s AS ({SCORED}),
 c AS (SELECT CAST(sum(CASE WHEN score >= 0.5 AND quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
              CAST(sum(CASE WHEN score >= 0.5 AND quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
              CAST(sum(CASE WHEN score < 0.5 AND quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
              CAST(sum(CASE WHEN score < 0.5 AND quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn FROM s)
SELECT tp, fp, tn, fn, {", ".join(f"round({v.replace('tp', 'tp::DOUBLE')}, 6) AS {k}" for k, v in m.items())} FROM c"""
    sql["auc"] = _auc_sql(None)
    sql["auc_by_lang"] = _auc_sql("lang")
    sql["threshold_sweep"] = _sweep_sql(19, None)
    sql["threshold_sweep_by_lang"] = _sweep_sql(21, "lang")
    sql["best_flags"] = f"""
WITH w AS ({_sweep_sql(19, None)})
SELECT *, precision = max(precision) OVER () AS best_precision, recall = max(recall) OVER () AS best_recall,
  f1 = max(f1) OVER () AS best_f1, accuracy = max(accuracy) OVER () AS best_accuracy, auc = max(auc) OVER () AS best_auc
FROM w"""
    dims = 64
    emb = ("SELECT vec_id, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(dims))
           + ", CAST(label >= 5 AS INTEGER) AS y FROM embeddings")
    terms = [f"(q.e{i} - d.e{i}) * (q.e{i} - d.e{i})" for i in range(dims)]
    ss = terms[0]
    for t in terms[1:]:
        ss = f"({ss}) + {t}"
    sql["knn_classify"] = f"""
WITH e AS ({emb}),
 r AS (SELECT q.vec_id AS qk, d.y AS dy, row_number() OVER (PARTITION BY q.vec_id
         ORDER BY sqrt({float(dims)}::DOUBLE / {dims} * ({ss})), d.vec_id) AS rn FROM e q, e d)
SELECT e.vec_id, e.y, CAST(avg(r.dy) > 0.5 AS INTEGER) AS prediction FROM r JOIN e ON e.vec_id = r.qk
WHERE r.rn <= 5 GROUP BY e.vec_id, e.y"""
    wide = [f"e{i}" for i in range(9)]
    gaps = ", ".join(f"CASE WHEN (vec_id * {2 * i + 3} + {i}) % 10 < 3 THEN NULL ELSE CAST(embedding[{i + 1}] AS DOUBLE) END AS e{i}"
                     for i in range(9))
    sql["knn_impute_wide"] = _knn_generic(f"w AS (SELECT vec_id, {gaps} FROM embeddings)", "w", "w", "vec_id", wide, [])
    sql.update(recipe_sql())
    sql["split_scan"] = _split_scan_sql(cat.SCAN_SEEDS)
    return sql


# ------------------------------------------------------------------ recipes (O18-O20 shapes)
def _knn_generic(prelude: str, points: str, rows: str, key: str, feats: list[str], keep: list[str],
                 k: int = 5, extra: list[str] = ()) -> str:
    """Uniform k-NN imputation in SQL over relations with columns (key, feats..., keep..., extra...).

    ``points`` are the fit rows (donors), ``rows`` the rows to fill; the same rule as KnnImpute.
    """
    p = len(feats)
    both = [f"q.{f} IS NOT NULL AND d.{f} IS NOT NULL" for f in feats]
    nc = " + ".join(f"(CASE WHEN {b} THEN 1 ELSE 0 END)" for b in both)
    terms = [f"(CASE WHEN {b} THEN (q.{f} - d.{f}) * (q.{f} - d.{f}) ELSE 0.0::DOUBLE END)" for b, f in zip(both, feats)]
    ss = terms[0]
    for t in terms[1:]:
        ss = f"({ss}) + {t}"
    v = "CASE q.t " + " ".join(f"WHEN {j} THEN d.{f}" for j, f in enumerate(feats)) + " END"
    qs = " UNION ALL ".join(f"SELECT {key}, {j} AS t, {', '.join(feats)} FROM {rows} WHERE {f} IS NULL"
                            for j, f in enumerate(feats))
    means = ", ".join(f"avg({f}) AS m{j}" for j, f in enumerate(feats))
    joins = " ".join(f"LEFT JOIN imp i{j} ON i{j}.qk = r.{key} AND i{j}.t = {j}" for j in range(p))
    outs = ", ".join(f"round(coalesce(r.{f}, i{j}.iv, m{j}), 6) AS {f}" for j, f in enumerate(feats))
    kept = "".join(f"r.{c}, " for c in [*keep, *extra])
    return f"""
WITH {prelude},
 kq AS ({qs}),
 kmeans AS (SELECT {means} FROM {points}),
 kpairs AS (SELECT q.{key} AS qk, q.t, d.{key} AS dk, {nc} AS nc, {ss} AS ss, {v} AS v FROM kq q, {points} d),
 kranked AS (SELECT qk, t, v, row_number() OVER (PARTITION BY qk, t ORDER BY sqrt({float(p)}::DOUBLE / nc * ss), dk) AS rn
             FROM kpairs WHERE nc > 0 AND v IS NOT NULL),
 imp AS (SELECT qk, t, avg(v) AS iv FROM kranked WHERE rn <= {k} GROUP BY qk, t)
SELECT r.{key}, {kept}{outs} FROM {rows} r CROSS JOIN kmeans {joins}"""


def _enc(name: str, column: str, m: float) -> str:
    """Target-encoding table of ``column`` fitted on the training rows of ``split``."""
    return (f" {name} AS (SELECT {column} AS v, count(*) AS n, avg(y) AS mc FROM split "
            f"WHERE NOT is_test AND {column} IS NOT NULL GROUP BY 1)")


def _enc_expr(table: str, m: float) -> str:
    return f"({table}.n * {table}.mc + {m} * g.gm) / ({table}.n + {m})"


def _quartiles(name: str, rel: str, column: str, median: bool = False) -> str:
    mid = f", quantile_cont({column}, 0.5) AS med" if median else ""
    return (f" {name} AS (SELECT quantile_cont({column}, 0.25) AS q1{mid}, quantile_cont({column}, 0.75) AS q3 "
            f"FROM {rel} WHERE NOT is_test)")


def _clip(column: str, q: str, w: float) -> str:
    return (f"CASE WHEN {column} IS NULL THEN NULL ELSE least(greatest({column}, {q}.q1 - {w} * ({q}.q3 - {q}.q1)), "
            f"{q}.q3 + {w} * ({q}.q3 - {q}.q1)) END")


def _robust(column: str, q: str) -> str:
    return (f"CASE WHEN {q}.q3 - {q}.q1 = 0 THEN {column} ELSE ({column} - {q}.med) / ({q}.q3 - {q}.q1) END")


def _recipe(base: str, key: str, seed: int, columns: dict, maps: dict, encoders: dict, clipped: list[str], width: float) -> tuple:
    """(CTEs up to ``t2``, the rows before imputation, and ``fitrows``, those of them in training; feature names)."""
    feats = [c for c in columns if c != "y"]
    split = _split_cte(f"(SELECT {key}, {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {base})", "y", key, seed, 0.2)
    ctes = [split.strip(), "g AS (SELECT avg(y) AS gm FROM split WHERE NOT is_test)"]
    first, second, joins = [], [], ["split s CROSS JOIN g"]
    for i, c in enumerate(feats):
        if c in maps:
            first.append(f"CAST({_case_map('s.' + c, maps[c], f'TRY_CAST(s.{c} AS BIGINT)')} AS DOUBLE) AS {c}")
        elif c in encoders:
            ctes.append(_enc(f"e{i}", c, encoders[c]).strip())
            first.append(f"{_enc_expr(f'e{i}', encoders[c])} AS {c}")
            joins.append(f"LEFT JOIN e{i} ON s.{c} = e{i}.v")
        else:
            ctes.append(_quartiles(f"t{i}q", "split", c).strip())
            first.append(f"{_clip('s.' + c, f't{i}q', width)} AS {c}")
            joins.append(f"CROSS JOIN t{i}q")
    ctes.append(f"t1 AS (SELECT s.{key}, s.y, s.is_test, {', '.join(first)} FROM {' '.join(joins)})")
    scaled = ["t1"]
    for i, c in enumerate(feats):
        if c in clipped:
            ctes.append(_quartiles(f"r{i}q", "t1", c, median=True).strip())
            second.append(f"{_robust(c, f'r{i}q')} AS {c}")
            scaled.append(f"r{i}q")
        else:
            second.append(c)
    ctes.append(f"t2 AS (SELECT {key}, y, is_test, {', '.join(second)} FROM {', '.join(scaled)})")
    ctes.append("fitrows AS (SELECT * FROM t2 WHERE NOT is_test)")
    return ",\n ".join(ctes), feats


HOMERUN_BASE = "documents JOIN labels USING (doc_id)"
HOMERUN_ENCODERS = {"home_team": 10.0, "batter_team": 10.0, "away_team": 10.0, "batter_name": 15.0, "pitcher_name": 15.0,
                    "bb_type": 5.0, "bearing": 5.0}


def _homerun_sql(seed: int) -> str:
    ctes, feats = _recipe(HOMERUN_BASE, "doc_id", seed, src.HOMERUN, {}, HOMERUN_ENCODERS, ["launch_speed", "launch_angle"], 3.0)
    return _knn_generic(ctes, "fitrows", "t2", "doc_id", feats, ["y"], extra=["is_test"])


def recipe_sql() -> dict[str, str]:
    out = {"recipe_c": _homerun_sql(cat.SPLIT_SEED)}
    ctes, feats = _recipe("events", "event_id", rec.CUSTOMER_SEED, src.CUSTOMER,
                          {"os": rec.OS_MAP, "experience": rec.LEVEL_MAP, "gender": rec.GENDER_MAP}, {"isp": 10.0},
                          ["age", "time_spent"], 1.5)
    out["recipe_b"] = _knn_generic(ctes, "fitrows", "t2", "event_id", feats, ["y"], extra=["is_test"])
    ctes, feats = _recipe("orders JOIN customer ON o_custkey = c_custkey", "o_orderkey", rec.PASSENGER_SEED, src.PASSENGER,
                          {"gender": rec.GENDER_MAP, "cabin": rec.CLASS_MAP}, {"port": 10.0}, ["age", "fare"], 3.0)
    out["recipe_a"] = _knn_generic(ctes, "fitrows", "t2", "o_orderkey", feats, ["y"], extra=["is_test"])
    return out


def _split_scan_sql(seeds) -> str:
    """Recipe C, a 5-nearest-neighbour vote of the training rows and F1 on both sides, all by seed; then the choice."""
    feats = [c for c in src.HOMERUN if c != "y"]
    clipped = ["launch_speed", "launch_angle"]
    p = len(feats)
    base = f"(SELECT doc_id, {', '.join(f'{e} AS {c}' for c, e in src.HOMERUN.items())} FROM {HOMERUN_BASE})"
    sizes = _split_cte(base, "y", "doc_id", 0, 0.2).split(" split_r AS")[0]
    ctes = [f"s AS (SELECT unnest({list(seeds)}) AS seed)", f"b AS {base}", sizes.strip().rstrip(","),
            """split AS (SELECT r.* EXCLUDE (rn), r.rn <= a.n - a.train_c AS is_test FROM (SELECT s.seed, b.*, row_number() OVER (PARTITION BY s.seed, b.y
               ORDER BY md5(concat_ws('|', b.doc_id, s.seed)), b.doc_id) AS rn FROM b, s) r JOIN split_a a ON r.y = a.y)""",
            "g AS (SELECT seed, avg(y) AS gm FROM split WHERE NOT is_test GROUP BY 1)"]
    first, second, joins = [], [], ["split x JOIN g ON g.seed = x.seed"]
    for i, c in enumerate(feats):
        if c in HOMERUN_ENCODERS:
            ctes.append(f"e{i} AS (SELECT seed, {c} AS v, count(*) AS n, avg(y) AS mc FROM split WHERE NOT is_test AND {c} IS NOT NULL GROUP BY 1, 2)")
            first.append(f"{_enc_expr(f'e{i}', HOMERUN_ENCODERS[c])} AS {c}")
            joins.append(f"LEFT JOIN e{i} ON x.{c} = e{i}.v AND e{i}.seed = x.seed")
        else:
            ctes.append(_quartiles(f"t{i}q", "split", c).strip().replace("SELECT ", "SELECT seed, ").replace("is_test)", "is_test GROUP BY seed)"))
            first.append(f"{_clip('x.' + c, f't{i}q', 3.0)} AS {c}")
            joins.append(f"JOIN t{i}q ON t{i}q.seed = x.seed")
    ctes.append(f"t1 AS (SELECT x.seed, x.doc_id, x.y, x.is_test, {', '.join(first)} FROM {' '.join(joins)})")
    scaled = ["t1 x"]
    for i, c in enumerate(feats):
        if c in clipped:
            ctes.append(_quartiles(f"r{i}q", "t1", c, median=True).strip().replace("SELECT ", "SELECT seed, ").replace("is_test)", "is_test GROUP BY seed)"))
            scaled.append(f"JOIN r{i}q ON r{i}q.seed = x.seed")
        second.append(f"{_robust('x.' + c, f'r{i}q')} AS {c}" if c in clipped else f"x.{c}")
    ctes.append(f"t2 AS MATERIALIZED (SELECT x.seed, x.doc_id, x.y, x.is_test, {', '.join(second)} FROM {' '.join(scaled)})")
    both = [f"q.{f} IS NOT NULL AND d.{f} IS NOT NULL" for f in feats]
    gaps = [f"(q.{f} - d.{f}) * (q.{f} - d.{f})" for f in feats]

    def total(terms: list[str]) -> str:
        out = terms[0]
        for t in terms[1:]:
            out = f"({out}) + {t}"
        return out

    common = " + ".join(f"(CASE WHEN {x} THEN 1 ELSE 0 END)" for x in both)
    shared = total([f"(CASE WHEN {x} THEN {t} ELSE 0.0::DOUBLE END)" for x, t in zip(both, gaps)])
    value = "CASE q.t " + " ".join(f"WHEN {j} THEN d.{f}" for j, f in enumerate(feats)) + " END"
    queries = " UNION ALL ".join(f"SELECT seed, doc_id, {j} AS t, {', '.join(feats)} FROM t2 WHERE {f} IS NULL" for j, f in enumerate(feats))
    ctes += [f"kq AS ({queries})",
             f"km AS (SELECT seed, {', '.join(f'avg({f}) AS m{j}' for j, f in enumerate(feats))} FROM t2 WHERE NOT is_test GROUP BY 1)",
             f"kp AS (SELECT q.seed, q.doc_id AS qk, q.t, d.doc_id AS dk, {common} AS nc, {shared} AS ss, {value} AS v FROM kq q JOIN t2 d ON d.seed = q.seed AND NOT d.is_test)",
             f"kr AS (SELECT seed, qk, t, v, row_number() OVER (PARTITION BY seed, qk, t ORDER BY sqrt({float(p)}::DOUBLE / nc * ss), dk) AS rn FROM kp WHERE nc > 0 AND v IS NOT NULL)",
             "ki AS (SELECT seed, qk, t, avg(v) AS iv FROM kr WHERE rn <= 5 GROUP BY ALL)"]
    filled = ", ".join(f"coalesce(x.{f}, i{j}.iv, m{j}) AS {f}" for j, f in enumerate(feats))
    looked_up = " ".join(f"LEFT JOIN ki i{j} ON i{j}.seed = x.seed AND i{j}.qk = x.doc_id AND i{j}.t = {j}" for j in range(p))
    ctes += [f"t3 AS MATERIALIZED (SELECT x.seed, x.doc_id, x.y, x.is_test, {filled} FROM t2 x JOIN km ON km.seed = x.seed {looked_up})",
             f"near AS (SELECT q.seed, q.doc_id, q.y, q.is_test, d.y AS dy, row_number() OVER (PARTITION BY q.seed, q.doc_id ORDER BY sqrt({total(gaps)}), d.doc_id) AS rn "
             "FROM t3 q JOIN t3 d ON d.seed = q.seed AND NOT d.is_test)"]
    f1 = "2 * {0} / nullif(2 * {0} + {1} + {2}, 0)"

    def count(test: str, y: int, pred: int) -> str:
        return f"sum(CASE WHEN {test} AND y = {y} AND p = {pred} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"

    train, tests = [f1.format(*[count(t, *yp) for yp in ((1, 1), (0, 1), (1, 0))]) for t in ("NOT is_test", "is_test")]
    return f"""
WITH {", ".join(ctes)},
 votes AS (SELECT seed, doc_id, y, is_test, CAST(avg(dy) > 0.5 AS INTEGER) AS p FROM near WHERE rn <= 5 GROUP BY ALL),
 f AS (SELECT seed, coalesce({train}, 0) AS train_f1, coalesce({tests}, 0) AS test_f1 FROM votes GROUP BY seed),
 r AS (SELECT seed, train_f1, CASE WHEN train_f1 >= 0.1 THEN test_f1 END AS test_f1,
       CASE WHEN train_f1 >= 0.1 THEN test_f1 / train_f1 END AS ratio, train_f1 < 0.1 AS skipped FROM f),
 c AS (SELECT seed AS best FROM r WHERE NOT skipped ORDER BY abs(ratio - (SELECT avg(ratio) FROM r)), seed LIMIT 1)
SELECT seed, round(train_f1, 6) AS train_f1, round(test_f1, 6) AS test_f1, round(ratio, 6) AS ratio, skipped,
       seed = best AS chosen FROM r, c"""

"""Registered queries: one per operator of the inventory, each reading the
driver tables at ``sf_dir``, plus the DuckDB twin used as the oracle.

Conventions shared by both sides: integer outputs are BIGINT, doubles are
rounded to 6 digits, every computed column is aliased identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.common import ts_micros

from foldwise import sqltext as S
from foldwise.functions.prep import minmax_fit
from foldwise.operators.splits import stratified_kfold
from foldwise.plans.evaluate import knn_cross_validate, rounded_summary
from foldwise.session import table
from foldwise.sources import driver_tables as dt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _plus_zero(sql: str) -> str:
    """``round(e, 6)`` -> ``(round(e, 6) + 0.0)``: a negative value that
    rounds to zero gives -0.0 in DuckDB but 0.0 in Spark; adding +0.0 makes
    both +0.0 so the value hashes agree."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        call = sql[j:k + 1]
        inner = _plus_zero(call[6:-1])
        call = "round(" + inner + ")"
        if inner.replace(" ", "").endswith(",6"):
            call = "(" + call + " + 0.0)"
        out.append(sql[i:j])
        out.append(call)
        i = k + 1


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _plus_zero(sql.strip())
        return fn
    return deco


# ------------------------------------------------------------------ shared SQL
EMB_BASE = """base AS (SELECT vec_id AS row_id, CAST(label AS VARCHAR) AS label,
  CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
ex AS (SELECT row_id, label, UNNEST(f) AS x, generate_subscripts(f, 1) - 1 AS pos FROM base)"""

EMB_MINMAX = """mm AS (SELECT pos, min(x) AS lo, max(x) AS hi FROM ex GROUP BY pos),
sc AS (SELECT e.row_id, e.pos, CASE WHEN mm.hi = mm.lo THEN 0.0 ELSE (e.x - mm.lo) / (mm.hi - mm.lo) END AS x
  FROM ex e JOIN mm ON e.pos = mm.pos)"""


def strat_folds_sql(src: str, k: int, seed: int = 42, label: str = "label") -> str:
    return (f"SELECT row_id, {label} AS label, CAST((row_number() OVER (PARTITION BY {label} ORDER BY "
            f"{S.fold_key('row_id', seed)}, row_id) - 1) % {k} + 1 AS INTEGER) AS fold FROM {src}")


# ------------------------------------------------------------- flagship (§7.2)
def _knn_cv_sql(k: int, folds: int) -> str:
    knn, knn_out = S.knn_ctes("sc", "folds", k, "lq.fold <> ld.fold")
    met, met_out = S.metrics_ctes("cnt", ["fold"], [str(i) for i in range(10)])
    return f"""WITH {EMB_BASE},
{EMB_MINMAX},
folds AS ({strat_folds_sql('base', folds)}),
{knn},
cnt AS (SELECT f.fold, f.label AS actual, p.predicted, count(*) AS n FROM folds f JOIN {knn_out} p
  ON p.row_id = f.row_id GROUP BY ALL),
{met}
{S.summary_select(met_out)}"""


@register("knn_cv_embeddings", _knn_cv_sql(5, 5))
def knn_cv_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> min-max -> stratified 5-fold -> kNN(k=5) over the other
    folds -> per-fold weighted metrics -> mean and sample std."""
    df = dt.embeddings(spark, sf_dir)
    df = minmax_fit(df).transform(df)
    df = stratified_kfold(df, 5, seed=42)
    res = knn_cross_validate(df, 5, classes=[str(i) for i in range(10)])
    return rounded_summary(res.summary)


def _knn_cv_fold_scaled_sql(k: int, folds: int) -> str:
    met, met_out = S.metrics_ctes("cnt", ["fold"], [str(i) for i in range(10)])
    return f"""WITH {EMB_BASE},
folds AS ({strat_folds_sql('base', folds)}),
fx AS (SELECT e.row_id, e.pos, e.x, f.fold, f.label FROM ex e JOIN folds f ON f.row_id = e.row_id),
pf AS (SELECT fold, pos, min(x) AS lo, max(x) AS hi FROM fx GROUP BY ALL),
st AS (SELECT a.fold, a.pos, min(b.lo) AS lo, max(b.hi) AS hi FROM pf a JOIN pf b ON a.pos = b.pos AND a.fold <> b.fold GROUP BY ALL),
kn_d AS (SELECT q.row_id AS qid, t.row_id AS did, round(sum(
    (CASE WHEN st.hi = st.lo THEN 0.0 ELSE (q.x - st.lo) / (st.hi - st.lo) END
     - CASE WHEN st.hi = st.lo THEN 0.0 ELSE (t.x - st.lo) / (st.hi - st.lo) END) *
    (CASE WHEN st.hi = st.lo THEN 0.0 ELSE (q.x - st.lo) / (st.hi - st.lo) END
     - CASE WHEN st.hi = st.lo THEN 0.0 ELSE (t.x - st.lo) / (st.hi - st.lo) END)), 9) AS d2
  FROM fx q JOIN fx t ON q.pos = t.pos AND q.fold <> t.fold JOIN st ON st.fold = q.fold AND st.pos = q.pos
  GROUP BY q.row_id, t.row_id),
kn_r AS (SELECT qid, did, row_number() OVER (PARTITION BY qid ORDER BY d2, did) AS rk FROM kn_d),
kn_v AS (SELECT r.qid, l.label, count(*) AS votes, max(r.rk) AS last FROM kn_r r JOIN folds l ON l.row_id = r.did
  WHERE r.rk <= {k} GROUP BY r.qid, l.label),
kn_p AS (SELECT qid AS row_id, label AS predicted FROM (SELECT *, row_number() OVER
  (PARTITION BY qid ORDER BY votes DESC, last ASC) AS r1 FROM kn_v) WHERE r1 = 1),
cnt AS (SELECT f.fold, f.label AS actual, p.predicted, count(*) AS n FROM folds f JOIN kn_p p
  ON p.row_id = f.row_id GROUP BY ALL),
{met}
{S.summary_select(met_out)}"""


@register("knn_cv_fold_scaled", _knn_cv_fold_scaled_sql(5, 5))
def knn_cv_fold_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leak-free flagship variant: min-max fitted on each fold's training
    rows only (the reference fits it on all rows first)."""
    df = stratified_kfold(dt.embeddings(spark, sf_dir), 5, seed=42)
    res = knn_cross_validate(df, 5, classes=[str(i) for i in range(10)], scale="per_fold")
    return rounded_summary(res.summary)


# =================================================================== B: prep
from foldwise.functions import prep as P  # noqa: E402
from foldwise.functions.common import rnd  # noqa: E402
from foldwise.operators import splits as SP  # noqa: E402

ORDERS_NULLS_SQL = """SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust,
  o_orderpriority AS label FROM orders"""


def _orders_nulls(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("double")).alias("cust"),
        F.col("o_orderpriority").alias("label"))


@register("missing_profile", f"""WITH t AS ({ORDERS_NULLS_SQL})
SELECT column_name, n_missing, {S.r('n_missing * 100.0 / n')} AS pct_missing FROM (
  SELECT 'price' AS column_name, CAST(count(*) FILTER (WHERE price IS NULL OR isnan(price)) AS BIGINT) AS n_missing, count(*) AS n FROM t
  UNION ALL SELECT 'cust', CAST(count(*) FILTER (WHERE cust IS NULL OR isnan(cust)) AS BIGINT), count(*) FROM t)""")
def q_missing_profile(spark, sf):
    prof = P.missing_profile(_orders_nulls(spark, sf), ["price", "cust"])
    return prof.select("column_name", F.col("n_missing").cast("bigint").alias("n_missing"),
                       rnd("pct_missing").alias("pct_missing"))


@register("missing_mean", f"""WITH t AS ({ORDERS_NULLS_SQL})
SELECT {S.r('avg(p)')} AS mean_pct_missing FROM (SELECT count(*) FILTER (WHERE price IS NULL) * 100.0 / count(*) AS p FROM t
  UNION ALL SELECT count(*) FILTER (WHERE cust IS NULL) * 100.0 / count(*) FROM t)""")
def q_missing_mean(spark, sf):
    prof = P.missing_profile(_orders_nulls(spark, sf), ["price", "cust"])
    return P.missing_mean(prof).select(rnd("mean_pct_missing").alias("mean_pct_missing"))


@register("impute_mean", f"""WITH t AS ({ORDERS_NULLS_SQL}),
m AS (SELECT avg(price) AS mp, avg(cust) AS mc FROM t)
SELECT row_id, {S.r('coalesce(price, mp)')} AS price, {S.r('coalesce(cust, mc)')} AS cust FROM t, m""")
def q_impute_mean(spark, sf):
    t = _orders_nulls(spark, sf)
    imp = P.impute_mean_fit(t, ["price", "cust"])
    out = imp.transform(t)
    return out.select("row_id", rnd("price").alias("price"), rnd("cust").alias("cust"))


@register("impute_zero", f"""WITH t AS ({ORDERS_NULLS_SQL})
SELECT row_id, {S.r('coalesce(price, 0.0)')} AS price, {S.r('coalesce(cust, 0.0)')} AS cust FROM t""")
def q_impute_zero(spark, sf):
    out = P.impute_zero(_orders_nulls(spark, sf), ["price", "cust"])
    return out.select("row_id", rnd("price").alias("price"), rnd("cust").alias("cust"))


@register("one_hot", """WITH c AS (SELECT o_orderpriority AS v, CAST(row_number() OVER (ORDER BY o_orderpriority) AS BIGINT) AS class_pos
  FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o.o_orderkey AS row_id, c.class_pos, (o.o_orderpriority = c.v) AS is_set
FROM orders o, c""")
def q_one_hot(spark, sf):
    o = dt.orders(spark, sf)
    enc, classes = P.one_hot(o, "label")
    return enc.select("row_id", F.posexplode("onehot").alias("p", "is_set")) \
        .select("row_id", (F.col("p") + 1).cast("bigint").alias("class_pos"), "is_set")


@register("one_hot_binary", """SELECT l.doc_id AS row_id, (CAST(l.toxic AS VARCHAR) = '0') AS is_first
FROM labels l""")
def q_one_hot_binary(spark, sf):
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"), F.col("toxic").cast("string").alias("t"))
    enc, classes = P.one_hot(lab, "t", classes=["0", "1"])
    return enc.select("row_id", F.col("onehot")[0].alias("is_first"))


@register("one_hot_decode", """WITH c AS (SELECT o_orderpriority AS v, CAST(row_number() OVER (ORDER BY o_orderpriority) AS BIGINT) AS class_pos
  FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o.o_orderkey AS row_id, o.o_orderpriority AS label, c.class_pos AS decoded
FROM orders o JOIN c ON c.v = o.o_orderpriority""")
def q_one_hot_decode(spark, sf):
    o = dt.orders(spark, sf)
    enc, _ = P.one_hot(o, "label")
    return enc.select("row_id", "label", P.one_hot_decode("onehot").alias("decoded"))


@register("parse_bool", """SELECT doc_id, (quality = 1) AS quality_b,
  lower(trim(' ' || CAST(toxic AS VARCHAR) || ' ')) IN ('1','true','t','yes','y','up') AS toxic_b,
  lower(trim(CASE WHEN toxic = 1 THEN ' Yes' ELSE 'no ' END)) IN ('1','true','t','yes','y','up') AS toxic_word_b
FROM labels""")
def q_parse_bool(spark, sf):
    lab = table(spark, sf, "labels").select(
        "doc_id", "quality", F.concat(F.lit(" "), F.col("toxic").cast("string"), F.lit(" ")).alias("toxic_s"),
        F.when(F.col("toxic") == 1, F.lit(" Yes")).otherwise(F.lit("no ")).alias("toxic_w"))
    return lab.select("doc_id", P.parse_bool(lab, "quality").alias("quality_b"),
                      P.parse_bool(lab, "toxic_s").alias("toxic_b"),
                      P.parse_bool(lab, "toxic_w").alias("toxic_word_b"))


@register("to_float", f"""SELECT o_orderkey AS row_id, {S.r('CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE)')} AS price,
  TRY_CAST(o_orderpriority AS DOUBLE) AS priority, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_num
FROM orders""")
def q_to_float(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").cast("string").alias("p"),
        "o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("pn"))
    return o.select("row_id", rnd(P.to_float("p")).alias("price"),
                    P.to_float("o_orderpriority", strict=False).alias("priority"),
                    P.to_float("pn", strict=False).alias("priority_num"))


def _gap_sql(expr: str, tbl: str, name: str) -> str:
    return f"""SELECT '{name}' AS column_name, CASE WHEN min(d) IS NULL THEN 0.0
  WHEN bool_and(abs(round(d / m) - d / m) < 1e-3) THEN min(d) ELSE 0.0 END AS gap FROM (
  SELECT d, min(d) OVER () AS m FROM (SELECT lead(v) OVER (ORDER BY v) - v AS d FROM
   (SELECT DISTINCT CAST({expr} AS DOUBLE) AS v FROM {tbl})) WHERE d IS NOT NULL)"""


@register("discrete_gap", f"""SELECT column_name, round(gap, 6) AS gap FROM (
{_gap_sql('p_size', 'part', 'p_size')} UNION ALL {_gap_sql('p_retailprice', 'part', 'p_retailprice')}
UNION ALL {_gap_sql('hour(ts)', 'events', 'hour')})""")
def q_discrete_gap(spark, sf):
    part = table(spark, sf, "part")
    ev = dt.events(spark, sf)
    out = None
    for df, c, name in [(part, "p_size", "p_size"), (part, "p_retailprice", "p_retailprice"), (ev, "hour", "hour")]:
        g = P.discrete_gap(df, c).select(F.lit(name).alias("column_name"), rnd("gap").alias("gap"))
        out = g if out is None else out.unionByName(g)
    return out


CYCLIC_SQL = """WITH h AS (SELECT event_id, CAST(hour(ts) AS DOUBLE) AS hr FROM events),
st AS (SELECT min(hr) AS lo, max(hr) AS hi FROM h),
g AS (SELECT CASE WHEN bool_and(abs(round(d / m) - d / m) < 1e-3) THEN min(d) ELSE 0.0 END AS gap FROM (
  SELECT d, min(d) OVER () AS m FROM (SELECT lead(v) OVER (ORDER BY v) - v AS d FROM (SELECT DISTINCT hr AS v FROM h))
  WHERE d IS NOT NULL)),
cy AS (SELECT event_id, hr, CASE WHEN lo = hi THEN 0.0 ELSE sin((hr - lo) / ((hi - lo) + gap) * (2 * pi())) END AS s,
  CASE WHEN lo = hi THEN 1.0 ELSE cos((hr - lo) / ((hi - lo) + gap) * (2 * pi())) END AS c FROM h, st, g)"""


@register("cyclical", CYCLIC_SQL + """
SELECT event_id, CAST(hr AS BIGINT) AS hour, round(s, 6) AS hour_sin, round(c, 6) AS hour_cos FROM cy""")
def q_cyclical(spark, sf):
    ev = dt.events(spark, sf)
    cyc = P.cyclical_fit(ev, "hour")
    s, c = cyc.columns("hour")
    return ev.select("event_id", F.col("hour").cast("bigint").alias("hour"), rnd(s).alias("hour_sin"),
                     rnd(c).alias("hour_cos"))


@register("minmax_scale", f"""WITH {EMB_BASE}, {EMB_MINMAX}
SELECT row_id, CAST(pos AS BIGINT) AS pos, round(x, 6) AS x FROM sc""")
def q_minmax(spark, sf):
    df = dt.embeddings(spark, sf)
    out = P.minmax_fit(df).transform(df)
    return out.select("row_id", F.posexplode("features").alias("pos", "x")) \
        .select("row_id", F.col("pos").cast("bigint").alias("pos"), rnd("x").alias("x"))


@register("minmax_apply_holdout", f"""WITH {EMB_BASE},
sp AS (SELECT row_id, CASE WHEN (row_number() OVER (ORDER BY {S.fold_key('row_id')}, row_id) - 1)
  < round_even(count(*) OVER () * 0.3, 0) THEN 'test' ELSE 'train' END AS split FROM base),
mm AS (SELECT pos, min(x) AS lo, max(x) AS hi FROM ex JOIN sp USING (row_id) WHERE split = 'train' GROUP BY pos)
SELECT e.row_id, CAST(e.pos AS BIGINT) AS pos, round(CASE WHEN hi = lo THEN 0.0 ELSE (e.x - lo) / (hi - lo) END, 6) AS x
FROM ex e JOIN mm ON e.pos = mm.pos JOIN sp USING (row_id) WHERE split = 'test'""")
def q_minmax_apply(spark, sf):
    df = SP.hold_out(dt.embeddings(spark, sf), 0.3)
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    out = P.minmax_fit(train).transform(test)
    return out.select("row_id", F.posexplode("features").alias("pos", "x")) \
        .select("row_id", F.col("pos").cast("bigint").alias("pos"), rnd("x").alias("x"))


@register("zscore_scale", f"""WITH {EMB_BASE},
zs AS (SELECT pos, avg(x) AS mu, coalesce(stddev_samp(x), 0.0) AS sd FROM ex GROUP BY pos)
SELECT row_id, CAST(e.pos AS BIGINT) AS pos, round(CASE WHEN sd = 0 THEN 0.0 ELSE (x - mu) / sd END, 6) AS x
FROM ex e JOIN zs ON e.pos = zs.pos""")
def q_zscore(spark, sf):
    df = dt.embeddings(spark, sf)
    out = P.zscore_fit(df).transform(df)
    return out.select("row_id", F.posexplode("features").alias("pos", "x")) \
        .select("row_id", F.col("pos").cast("bigint").alias("pos"), rnd("x").alias("x"))


@register("classify_outputs", f"""WITH {EMB_BASE}
SELECT row_id, CAST(list_position(f, list_max(f)) AS BIGINT) AS predicted_pos, (f[1] >= 0.5) AS first_on FROM base""")
def q_classify_outputs(spark, sf):
    df = dt.embeddings(spark, sf)
    oh = P.classify_outputs("features")
    return df.select("row_id", P.one_hot_decode(oh).alias("predicted_pos"),
                     P.classify_outputs(F.col("features")[0], 0.5, multi=False).alias("first_on"))


PATTERN_SQL = """pat AS (SELECT vec_id AS row_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x >= 0) AS b FROM embeddings)"""


@register("binarize", f"""WITH {PATTERN_SQL}
SELECT row_id, array_to_string(list_transform(b, lambda x: CASE WHEN x THEN '1' ELSE '0' END), '') AS bits FROM pat""")
def q_binarize(spark, sf):
    df = dt.embeddings(spark, sf)
    b = P.binarize("features", 0.0)
    return df.select("row_id", F.array_join(F.transform(b, lambda x: F.when(x, "1").otherwise("0")), "").alias("bits"))


@register("crop", f"""WITH {PATTERN_SQL}
SELECT row_id, array_to_string(list_transform(range(0, 64), lambda i: CASE WHEN i % 8 >= 6 THEN '0'
  WHEN b[i + 1] THEN '1' ELSE '0' END), '') AS bits FROM pat""")
def q_crop(spark, sf):
    df = dt.embeddings(spark, sf)
    c = P.crop(P.binarize("features", 0.0), 8, 0.25)
    return df.select("row_id", F.array_join(F.transform(c, lambda x: F.when(x, "1").otherwise("0")), "").alias("bits"))


@register("rename_features", """SELECT CAST(p_size AS DOUBLE) AS x1, p_retailprice AS x2, CAST(p_size > 25 AS VARCHAR) AS label FROM part""")
def q_rename(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_size").cast("double"), "p_retailprice",
                                         (F.col("p_size") > 25).cast("string").alias("label"))
    return P.rename_features(p)


@register("drop_columns", """SELECT event_id, ts, user_id, event_type FROM events""")
def q_drop(spark, sf):
    return P.drop_columns(table(spark, sf, "events"), "value", "props")


# ================================================================ E, C: splits
def _orders_keyed(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("grp"),
                                             F.col("o_orderpriority").alias("label"))


def _rn(key: str, part: str = "") -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"(row_number() OVER ({p}ORDER BY {S.fold_key(key)}, {key}) - 1)"


@register("hold_out", f"""SELECT o_orderkey AS row_id, CASE WHEN {_rn('o_orderkey')}
  < round_even(count(*) OVER () * 0.2, 0) THEN 'test' ELSE 'train' END AS split FROM orders""")
def q_hold_out(spark, sf):
    return SP.hold_out(_orders_keyed(spark, sf), 0.2).select("row_id", "split")


@register("hold_out3", f"""WITH t AS (SELECT o_orderkey AS row_id, {_rn('o_orderkey')} AS p, count(*) OVER () AS n FROM orders),
s AS (SELECT row_id, p, n, n - round_even(n * (1 - 0.2), 0) AS nt FROM t),
s2 AS (SELECT *, (n - nt) - round_even((n - nt) - 0.1 * n, 0) AS nv FROM s)
SELECT row_id, CASE WHEN p < nt THEN 'test' WHEN p < nt + nv THEN 'val' ELSE 'train' END AS split FROM s2""")
def q_hold_out3(spark, sf):
    return SP.hold_out3(_orders_keyed(spark, sf), 0.1, 0.2).select("row_id", "split")


@register("group_hold_out", f"""WITH g AS (SELECT grp, CASE WHEN {_rn('grp')} < round_even(count(*) OVER () * 0.25, 0)
  THEN 'test' ELSE 'train' END AS split FROM (SELECT DISTINCT o_custkey AS grp FROM orders))
SELECT o.o_orderkey AS row_id, o.o_custkey AS grp, g.split FROM orders o JOIN g ON g.grp = o.o_custkey""")
def q_group_hold_out(spark, sf):
    return SP.group_hold_out(_orders_keyed(spark, sf), 0.25).select("row_id", "grp", "split")


@register("members", f"""WITH g AS (SELECT grp FROM (SELECT grp, {_rn('grp')} AS p, count(*) OVER () AS n
  FROM (SELECT DISTINCT o_custkey AS grp FROM orders)) WHERE p < round_even(n * 0.25, 0))
SELECT o_orderkey AS row_id, o_custkey AS grp FROM orders WHERE o_custkey IN (SELECT grp FROM g)""")
def q_members(spark, sf):
    o = _orders_keyed(spark, sf)
    ids = SP.hold_out(o.select("grp").distinct(), 0.25, id_col="grp").where("split = 'test'")
    return SP.members(o, ids, "grp").select("row_id", "grp")


@register("kfold", f"""SELECT o_orderkey AS row_id, CAST({_rn('o_orderkey')} % 5 + 1 AS INTEGER) AS fold FROM orders""")
def q_kfold(spark, sf):
    return SP.kfold(_orders_keyed(spark, sf), 5).select("row_id", "fold")


@register("stratified_kfold", f"""SELECT o_orderkey AS row_id, o_orderpriority AS label,
  CAST({_rn('o_orderkey', 'o_orderpriority')} % 5 + 1 AS INTEGER) AS fold FROM orders""")
def q_stratified_kfold(spark, sf):
    return SP.stratified_kfold(_orders_keyed(spark, sf), 5).select("row_id", "label", "fold")


@register("grouped_kfold", f"""WITH g AS (SELECT grp, CAST({_rn('grp')} % 4 + 1 AS INTEGER) AS fold
  FROM (SELECT DISTINCT o_custkey AS grp FROM orders))
SELECT g.fold, count(*) AS n_rows, count(DISTINCT o.o_custkey) AS n_groups
FROM orders o JOIN g ON g.grp = o.o_custkey GROUP BY g.fold""")
def q_grouped_kfold(spark, sf):
    return SP.grouped_kfold_report(SP.grouped_kfold(_orders_keyed(spark, sf), 4))


# keys with NULLs: every row keeps its place, a NULL group is a group
NULL_KEYS_SQL = """o AS (SELECT o_orderkey AS row_id, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS grp,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS label FROM orders)"""


def _orders_null_keys(spark, sf):
    o = _orders_keyed(spark, sf)
    return o.withColumn("grp", F.when(F.col("grp") % 5 != 0, F.col("grp"))).withColumn("label", F.when(F.col("row_id") % 7 != 0, F.col("label")))


@register("stratified_kfold_nulls", f"""WITH {NULL_KEYS_SQL}
SELECT row_id, label, CAST({_rn('row_id', 'label')} % 5 + 1 AS INTEGER) AS fold FROM o""")
def q_stratified_kfold_nulls(spark, sf):
    return SP.stratified_kfold(_orders_null_keys(spark, sf), 5).select("row_id", "label", "fold")


@register("grouped_kfold_nulls", f"""WITH {NULL_KEYS_SQL},
g AS (SELECT grp, CAST((row_number() OVER (ORDER BY {S.fold_key("coalesce(CAST(grp AS VARCHAR), '')")}, grp) - 1) % 4 + 1 AS INTEGER) AS fold
  FROM (SELECT DISTINCT grp FROM o))
SELECT row_id, fold FROM o JOIN g ON g.grp IS NOT DISTINCT FROM o.grp""")
def q_grouped_kfold_nulls(spark, sf):
    return SP.grouped_kfold(_orders_null_keys(spark, sf), 4).select("row_id", "fold")


@register("group_hold_out_nulls", f"""WITH {NULL_KEYS_SQL}, d AS (SELECT DISTINCT grp FROM o),
g AS (SELECT grp, CASE WHEN row_number() OVER (ORDER BY {S.fold_key("coalesce(CAST(grp AS VARCHAR), '')")}, grp) - 1
  < round_even(count(*) OVER () * 0.3, 0) THEN 'test' ELSE 'train' END AS split FROM d)
SELECT row_id, split FROM o JOIN g ON g.grp IS NOT DISTINCT FROM o.grp""")
def q_group_hold_out_nulls(spark, sf):
    return SP.group_hold_out(_orders_null_keys(spark, sf), 0.3).select("row_id", "split")


@register("split_by_fold", f"""WITH f AS (SELECT CAST({_rn('o_orderkey')} % 5 + 1 AS INTEGER) AS fold FROM orders),
k AS (SELECT DISTINCT fold AS f FROM f)
SELECT k.f AS fold, CAST(sum(CASE WHEN f.fold <> k.f THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
  CAST(sum(CASE WHEN f.fold = k.f THEN 1 ELSE 0 END) AS BIGINT) AS n_test FROM f, k GROUP BY k.f""")
def q_split_by_fold(spark, sf):
    d = SP.kfold(_orders_keyed(spark, sf), 5)
    out = None
    for f in range(1, 6):
        tr, te = SP.split_by_fold(d, f)
        one = tr.agg(F.count(F.lit(1)).alias("n_train")).withColumn("_k", F.lit(1)).join(
            te.agg(F.count(F.lit(1)).alias("n_test")).withColumn("_k", F.lit(1)), "_k") \
            .select(F.lit(f).alias("fold"), "n_train", "n_test")
        out = one if out is None else out.unionByName(one)
    return out


EVENTS_SEQ_SQL = "SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS seq FROM events"


def _events_seq(spark, sf):
    ev = dt.events(spark, sf).withColumn("ts_key", ts_micros("ts"))
    return SP.row_seq(ev, "ts_key", "event_id")


@register("batches", f"""SELECT event_id, seq, CAST(seq // 100 AS BIGINT) AS batch FROM ({EVENTS_SEQ_SQL})""")
def q_batches(spark, sf):
    return SP.batches(_events_seq(spark, sf), 100).select("event_id", "seq", "batch")


@register("batches_shuffled", f"""SELECT event_id, CAST(({_rn('event_id')}) // 100 AS BIGINT) AS batch FROM events""")
def q_batches_shuffled(spark, sf):
    ev = dt.events(spark, sf)
    return SP.batches(ev, 100, shuffle=True, id_col="event_id").select("event_id", "batch")


@register("union_batches", f"""WITH s AS ({EVENTS_SEQ_SQL})
SELECT CAST(CASE WHEN seq < 1000 THEN 0 ELSE 1 END AS INTEGER) AS part, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq
FROM s GROUP BY ALL""")
def q_union_batches(spark, sf):
    s = _events_seq(spark, sf)
    u = SP.union_batches(s.where("seq < 1000"), s.where("seq >= 1000"))
    return u.groupBy(F.col("part").cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


@register("select_rows", """SELECT l.l_linenumber AS ord, o.o_orderkey AS row_id, round(o.o_totalprice, 6) AS price
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def q_select_rows(spark, sf):
    picks = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("ord"), F.col("l_orderkey").alias("row_id"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), rnd("o_totalprice").alias("price"))
    return SP.select_rows(o, picks)


# ================================================================ D: statistics
from foldwise.operators import stats as ST  # noqa: E402
from foldwise.operators import scoring as G  # noqa: E402


def _lineitem_long(spark, sf, label="l_returnflag"):
    li = dt.lineitem(spark, sf, label)
    return G.to_long(li, dt.LINEITEM_FEATURES, "label")


LI_LONG_SQL = """li AS (SELECT l_returnflag AS label, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS cls,
  l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
lg AS (SELECT cls, 'l_quantity' AS feature, l_quantity AS x FROM li UNION ALL SELECT cls, 'l_extendedprice', l_extendedprice FROM li
  UNION ALL SELECT cls, 'l_discount', l_discount FROM li UNION ALL SELECT cls, 'l_tax', l_tax FROM li)"""


@register("dataset_summary", """SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_features,
  count(DISTINCT o_orderpriority) AS n_classes, count(DISTINCT o_custkey) AS n_groups FROM orders""")
def q_dataset_summary(spark, sf):
    return ST.dataset_summary(dt.orders(spark, sf), group="grp")


@register("class_distribution", "SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1")
def q_class_distribution(spark, sf):
    return ST.class_distribution(dt.lineitem(spark, sf))


@register("histogram", f"""WITH {LI_LONG_SQL},
st AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM lg GROUP BY feature)
SELECT lg.feature, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / (hi - lo) * 20), 19) END AS BIGINT) AS bin,
  count(*) AS n FROM lg JOIN st ON st.feature = lg.feature GROUP BY ALL""")
def q_histogram(spark, sf):
    return ST.histogram(_lineitem_long(spark, sf), 20)


@register("five_number", f"""WITH {LI_LONG_SQL}
SELECT feature, round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
  round(quantile_cont(x, 0.75), 6) AS q3, round(max(x), 6) AS max FROM lg GROUP BY feature""")
def q_five_number(spark, sf):
    f = ST.five_number(_lineitem_long(spark, sf))
    return f.select("feature", *[rnd(c).alias(c) for c in ["min", "q1", "median", "q3", "max"]])


@register("five_number_nulls", f"""WITH {LI_LONG_SQL},
h AS (SELECT feature, x FROM lg WHERE CAST(round(x * 100) AS BIGINT) % 5 <> 0)
SELECT feature, round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
  round(quantile_cont(x, 0.75), 6) AS q3, round(max(x), 6) AS max FROM h GROUP BY feature""")
def q_five_number_nulls(spark, sf):
    """D4 with NULL and NaN values in every feature: they have no rank."""
    d = _lineitem_long(spark, sf)
    cents = F.round(F.col("x") * 100).cast("bigint")
    x = F.when(cents % 5 != 0, F.col("x")).when(cents % 10 == 0, F.lit(float("nan")))
    f = ST.five_number(d.withColumn("x", x))
    return f.select("feature", *[rnd(c).alias(c) for c in ["min", "q1", "median", "q3", "max"]])


@register("correlation_matrix", f"""WITH {EMB_BASE},
e10 AS (SELECT row_id, pos, x FROM ex WHERE pos < 10),
p AS (SELECT a.pos AS i, b.pos AS j, a.x AS xi, b.x AS xj FROM e10 a JOIN e10 b ON a.row_id = b.row_id)
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(CASE WHEN stddev_pop(xi) * stddev_pop(xj) = 0 THEN NULL
  ELSE covar_pop(xi, xj) / (stddev_pop(xi) * stddev_pop(xj)) END, 6) AS r FROM p GROUP BY i, j""")
def q_correlation_matrix(spark, sf):
    df = dt.embeddings(spark, sf).select(F.slice("features", 1, 10).alias("features"))
    cm = ST.correlation_from_vectors(df, 10)
    return cm.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), rnd("r").alias("r"))


@register("first_per_class", f"""WITH {EMB_BASE}
SELECT label, min(row_id) AS row_id, round(arg_min(f[1], row_id), 6) AS x1 FROM base GROUP BY label""")
def q_first_per_class(spark, sf):
    df = dt.embeddings(spark, sf).select("row_id", "label", F.col("features")[0].alias("x1"))
    return ST.first_per_class(df).select("label", "row_id", rnd("x1").alias("x1"))


@register("mean_template", f"""WITH {EMB_BASE}
SELECT label, CAST(pos AS BIGINT) AS pos, round(avg(x), 6) AS mean FROM ex GROUP BY label, pos""")
def q_mean_template(spark, sf):
    m = ST.mean_template(dt.embeddings(spark, sf))
    return m.select("label", F.col("pos").cast("bigint").alias("pos"), rnd("mean").alias("mean"))


@register("hebbian_weights", f"""WITH {EMB_BASE},
pm AS (SELECT row_id, pos, CASE WHEN x >= 0 THEN 1.0 ELSE -1.0 END AS s FROM ex),
n AS (SELECT count(*) AS n FROM base)
SELECT CAST(a.pos AS BIGINT) AS i, CAST(b.pos AS BIGINT) AS j,
  round(CASE WHEN a.pos = b.pos THEN 0.0 ELSE sum(a.s * b.s) / max(n.n) END, 6) AS w
FROM pm a JOIN pm b ON a.row_id = b.row_id, n GROUP BY a.pos, b.pos""")
def q_hebbian(spark, sf):
    w = ST.hebbian_weights(dt.embeddings(spark, sf), 64)
    return w.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), rnd("w").alias("w"))


@register("covariance", f"""WITH {EMB_BASE}
SELECT CAST(a.pos AS BIGINT) AS i, CAST(b.pos AS BIGINT) AS j, round(covar_samp(a.x, b.x), 6) AS cov
FROM ex a JOIN ex b ON a.row_id = b.row_id GROUP BY a.pos, b.pos""")
def q_covariance(spark, sf):
    c = ST.covariance(dt.embeddings(spark, sf), 64)
    return c.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), rnd("cov").alias("cov"))


# ================================================================= D: metrics
from foldwise.operators import compare as CMP  # noqa: E402
from foldwise.operators import metrics as M  # noqa: E402

PART_RULES = [  # method name, predicate on part (Spark expression text == SQL text)
    ("price_1500", "p_retailprice >= 1500"),
    ("size_26", "p_size >= 26"),
    ("size_20", "p_size >= 20"),
    ("price_1200", "p_retailprice >= 1200"),
    ("price_lt_1000", "p_retailprice < 1000"),
]


def _part_rule_predictions(spark, sf):
    """(row_id, fold, method, actual, predicted) for five fixed rules."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("row_id"), "p_size", "p_retailprice")
    p = SP.kfold(p, 5)
    rules = F.array(*[F.struct(F.lit(n).alias("method"), F.expr(e).cast("string").alias("predicted"))
                      for n, e in PART_RULES])
    return p.select("row_id", "fold", (F.col("p_size") > 25).cast("string").alias("actual"),
                    F.inline(rules))


PART_RULES_SQL = "part_pred AS (" + " UNION ALL ".join(
    f"SELECT p_partkey AS row_id, f.fold, '{n}' AS method, CAST(p_size > 25 AS VARCHAR) AS actual, "
    f"CAST({e} AS VARCHAR) AS predicted FROM part JOIN part_folds f ON f.row_id = p_partkey" for n, e in PART_RULES) + ")"
PART_FOLDS_SQL = f"part_folds AS (SELECT p_partkey AS row_id, CAST({_rn('p_partkey')} % 5 + 1 AS INTEGER) AS fold FROM part)"


@register("accuracy", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL}
SELECT method, round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM part_pred GROUP BY method""")
def q_accuracy(spark, sf):
    a = M.accuracy(_part_rule_predictions(spark, sf), "actual", "predicted", ["method"])
    return a.select("method", rnd("accuracy").alias("accuracy"))


@register("accuracy_onehot", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL}
SELECT method, round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM part_pred GROUP BY method""")
def q_accuracy_onehot(spark, sf):
    """D7, one-hot form: a row is right when all columns agree."""
    p = _part_rule_predictions(spark, sf)
    hot = lambda c: F.array(*[(F.col(c) == F.lit(k)) for k in PART_CLASSES])
    a = M.accuracy_onehot(p.withColumn("a", hot("actual")).withColumn("p", hot("predicted")), "a", "p", ["method"])
    return a.select("method", rnd("accuracy").alias("accuracy"))


def _binary_select(prefix_cols: str = "") -> str:
    return f"""SELECT {prefix_cols}CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
  round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS accuracy,
  round(1 - CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS error_rate,
  round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS recall,
  round(CASE WHEN tn + fp = 0 THEN 1.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END, 6) AS specificity,
  round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tn + fn = 0 THEN 1.0 ELSE CAST(tn AS DOUBLE) / (tn + fn) END, 6) AS npv,
  round(CASE WHEN rc = 0 AND pp = 0 THEN 0.0 ELSE 2 * rc * pp / (rc + pp) END, 6) AS f1 FROM (
  SELECT *, CASE WHEN tp + fn = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS rc,
    CASE WHEN tp + fp = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS pp FROM cells)"""


def _round_metrics(df, keys=(), cells=()):
    return df.select(*keys, *[F.col(c).cast("bigint").alias(c) for c in cells], *[rnd(m).alias(m) for m in M.METRICS])


@register("confusion_binary", f"""WITH cells AS (SELECT
  count(*) FILTER (WHERE NOT (p_size > 25) AND NOT (p_retailprice >= 1500)) AS tn,
  count(*) FILTER (WHERE NOT (p_size > 25) AND (p_retailprice >= 1500)) AS fp,
  count(*) FILTER (WHERE (p_size > 25) AND NOT (p_retailprice >= 1500)) AS fn,
  count(*) FILTER (WHERE (p_size > 25) AND (p_retailprice >= 1500)) AS tp FROM part)
{_binary_select()}""")
def q_confusion_binary(spark, sf):
    p = table(spark, sf, "part").select((F.col("p_size") > 25).alias("actual"), "p_retailprice")
    c = M.confusion_binary(p, "actual", F.col("p_retailprice") / 1500.0, threshold=1.0)
    return _round_metrics(c, cells=["tn", "fp", "fn", "tp"])


@register("confusion_binary_by_fold", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL},
cells AS (SELECT method, fold, count(*) FILTER (WHERE actual = 'false' AND predicted = 'false') AS tn,
  count(*) FILTER (WHERE actual = 'false' AND predicted = 'true') AS fp,
  count(*) FILTER (WHERE actual = 'true' AND predicted = 'false') AS fn,
  count(*) FILTER (WHERE actual = 'true' AND predicted = 'true') AS tp FROM part_pred GROUP BY method, fold)
{_binary_select('method, fold, ')}""")
def q_confusion_binary_by_fold(spark, sf):
    p = _part_rule_predictions(spark, sf).select(
        "method", "fold", (F.col("actual") == "true").alias("a"), (F.col("predicted") == "true").alias("p"))
    c = M.confusion_binary(p, "a", "p", ["method", "fold"])
    return _round_metrics(c, ["method", "fold"], ["tn", "fp", "fn", "tp"])


LI_RULE = "CASE WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END"


def _li_rule_counts(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("actual"), F.expr(LI_RULE).alias("predicted"))
    return M.confusion_counts(li, "actual", "predicted")


def _metric_sql(counts_sql: str, keys, classes, weighted, select_keys=""):
    met, out = S.metrics_ctes("cnt", list(keys), classes, weighted)
    cols = ", ".join(f"round({m}, 6) AS {m}" for m in M.METRICS)
    return f"""WITH cnt AS ({counts_sql}),
{met}
SELECT {select_keys}n, {cols} FROM {out}"""


LI_COUNTS_SQL = f"SELECT l_returnflag AS actual, {LI_RULE} AS predicted, count(*) AS n FROM lineitem GROUP BY ALL"


@register("confusion_multiclass", _metric_sql(LI_COUNTS_SQL, [], ["A", "N", "R"], True))
def q_confusion_multiclass(spark, sf):
    m = M.multiclass_metrics(_li_rule_counts(spark, sf), ["A", "N", "R"], weighted=True)
    return _round_metrics(m, cells=["n"])


@register("confusion_multiclass_macro", _metric_sql(LI_COUNTS_SQL, [], ["A", "N", "R"], False))
def q_confusion_multiclass_macro(spark, sf):
    m = M.multiclass_metrics(_li_rule_counts(spark, sf), ["A", "N", "R"], weighted=False)
    return _round_metrics(m, cells=["n"])


@register("confusion_matrix", f"""WITH cnt AS ({LI_COUNTS_SQL}),
cl AS (SELECT * FROM (VALUES ('A'), ('N'), ('R')) t(c))
SELECT a.c AS actual, p.c AS predicted, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n FROM cl a CROSS JOIN cl p
LEFT JOIN cnt ON cnt.actual = a.c AND cnt.predicted = p.c""")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_li_rule_counts(spark, sf), ["A", "N", "R"])


ORD_RULE = "CASE WHEN o_totalprice < 50000 THEN '1-URGENT' WHEN o_totalprice < 150000 THEN '3-MEDIUM' ELSE '5-LOW' END"


@register("confusion_labels", _metric_sql(
    f"SELECT o_orderpriority AS actual, {ORD_RULE} AS predicted, count(*) AS n FROM orders GROUP BY ALL", [], None, True))
def q_confusion_labels(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("actual"), F.expr(ORD_RULE).alias("predicted"))
    return _round_metrics(M.confusion_labels(o, "actual", "predicted"), cells=["n"])


@register("confusion_report", f"""WITH cnt AS ({LI_COUNTS_SQL}),
{S.metrics_ctes('cnt', [], ['A', 'N', 'R'], True)[0]}
SELECT metric, round(value, 6) AS value FROM (UNPIVOT m_out ON {', '.join(M.METRICS)} INTO NAME metric VALUE value)""")
def q_confusion_report(spark, sf):
    m = M.multiclass_metrics(_li_rule_counts(spark, sf), ["A", "N", "R"])
    return M.confusion_report(m).select("metric", rnd("value").alias("value"))


PART_COUNTS_SQL = "SELECT method, fold, actual, predicted, count(*) AS n FROM part_pred GROUP BY ALL"


def _fold_summary_sql(weighted=True):
    met, out = S.metrics_ctes("cnt", ["method", "fold"], ["false", "true"], weighted)
    return f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL},
cnt AS ({PART_COUNTS_SQL}),
{met}
{S.summary_select(out, ['method'])}"""


@register("fold_summary", _fold_summary_sql())
def q_fold_summary(spark, sf):
    from foldwise.plans.evaluate import evaluate_predictions
    res = evaluate_predictions(_part_rule_predictions(spark, sf), ["false", "true"], group_cols=["method"])
    return rounded_summary(res.summary, keep=["method"])


@register("fold_matrix_sum", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL}
SELECT method, actual, predicted, count(*) AS n FROM part_pred GROUP BY ALL""")
def q_fold_matrix_sum(spark, sf):
    from foldwise.plans.evaluate import evaluate_predictions
    res = evaluate_predictions(_part_rule_predictions(spark, sf), ["false", "true"], group_cols=["method"])
    return res.matrix.where("n > 0")


@register("repetition_mean", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL},
rep AS (SELECT fold, CAST(substr(method, 1, 4) AS VARCHAR) AS family, method AS rep,
  avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS accuracy FROM part_pred GROUP BY ALL),
pf AS (SELECT family, fold, avg(accuracy) AS accuracy FROM rep GROUP BY ALL)
SELECT family, CAST(count(*) AS BIGINT) AS n_folds, round(avg(accuracy), 6) AS accuracy_mean, round(stddev_samp(accuracy), 6) AS accuracy_std
FROM pf GROUP BY family""")
def q_repetition_mean(spark, sf):
    p = _part_rule_predictions(spark, sf).withColumn("family", F.substring("method", 1, 4))
    rep = p.groupBy("fold", "family", F.col("method").alias("rep")).agg(
        F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("accuracy"))
    for m in M.METRICS[1:]:
        rep = rep.withColumn(m, F.lit(0.0))
    s = M.repetition_mean(rep, "fold", ["family"])
    return s.select("family", F.col("n_folds").cast("bigint"), rnd("accuracy_mean").alias("accuracy_mean"),
                    rnd("accuracy_std").alias("accuracy_std"))


# ============================================================ E9-E13: compare
PRICE_T = [1000, 1200, 1500, 1800]
SIZE_T = [10, 20, 26, 30]


def _sweep_results(spark, sf):
    p = table(spark, sf, "part").select("p_size", "p_retailprice")
    cfg = F.array(*[F.struct(F.lit("price").alias("model"), F.lit(i).alias("config_id"),
                             (F.col("p_retailprice") >= t).alias("pred")) for i, t in enumerate(PRICE_T)],
                  *[F.struct(F.lit("size").alias("model"), F.lit(i).alias("config_id"),
                             (F.col("p_size") >= t).alias("pred")) for i, t in enumerate(SIZE_T)])
    x = p.select((F.col("p_size") > 25).alias("actual"), F.inline(cfg))
    return x.groupBy("model", "config_id").agg(F.avg((F.col("actual") == F.col("pred")).cast("double")).alias("acc_mean"))


SWEEP_SQL = "sweep AS (" + " UNION ALL ".join(
    [f"SELECT 'price' AS model, {i} AS config_id, avg(CASE WHEN (p_size > 25) = (p_retailprice >= {t}) THEN 1.0 ELSE 0.0 END) AS acc_mean FROM part"
     for i, t in enumerate(PRICE_T)] +
    [f"SELECT 'size', {i}, avg(CASE WHEN (p_size > 25) = (p_size >= {t}) THEN 1.0 ELSE 0.0 END) FROM part"
     for i, t in enumerate(SIZE_T)]) + ")"


@register("leaderboard", f"""WITH {SWEEP_SQL}
SELECT model, CAST(config_id AS INTEGER) AS config_id, round(acc_mean, 6) AS acc_mean,
  CAST(row_number() OVER (PARTITION BY model ORDER BY acc_mean DESC, config_id) AS BIGINT) AS model_rank,
  CASE WHEN row_number() OVER (PARTITION BY model ORDER BY acc_mean DESC, config_id) = 1 THEN '*' ELSE '' END AS best FROM sweep""")
def q_leaderboard(spark, sf):
    lb = CMP.leaderboard(_sweep_results(spark, sf))
    return lb.select("model", F.col("config_id").cast("int"), rnd("acc_mean").alias("acc_mean"), "model_rank", "best")


@register("overall_order", f"""WITH {SWEEP_SQL}
SELECT model, CAST(config_id AS INTEGER) AS config_id, CAST(row_number() OVER (ORDER BY acc_mean DESC, model, config_id) AS BIGINT) AS place FROM sweep""")
def q_overall_order(spark, sf):
    return CMP.overall_order(_sweep_results(spark, sf)).select("model", F.col("config_id").cast("int"), "place")


RANKS_SQL = """acc AS (SELECT fold, method, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) AS value FROM part_pred GROUP BY ALL),
rk AS (SELECT fold, method, value, CAST(rank() OVER (PARTITION BY fold ORDER BY value DESC) AS DOUBLE)
  + (count(*) OVER (PARTITION BY fold, value) - 1) / 2.0 AS rank FROM acc)"""


def _ranks(spark, sf):
    acc = CMP.per_fold_comparison(_part_rule_predictions(spark, sf), model="method")
    return CMP.tied_ranks(acc)


@register("tied_ranks", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL}, {RANKS_SQL}
SELECT fold, method, round(value, 6) AS value, round(rank, 6) AS rank FROM rk""")
def q_tied_ranks(spark, sf):
    return _ranks(spark, sf).select("fold", "method", rnd("value").alias("value"), rnd("rank").alias("rank"))


@register("per_fold_comparison", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL}
SELECT fold, method, round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS value FROM part_pred GROUP BY ALL""")
def q_per_fold_comparison(spark, sf):
    acc = CMP.per_fold_comparison(_part_rule_predictions(spark, sf), model="method")
    return acc.select("fold", "method", rnd("value").alias("value"))


Q_SQL = "[" + ", ".join(str(v) for v in CMP.Q_ALPHA_05) + "]"


@register("nemenyi_cd", f"""WITH {PART_FOLDS_SQL}, {PART_RULES_SQL}, {RANKS_SQL},
kn AS (SELECT count(DISTINCT method) AS k, count(DISTINCT fold) AS nb FROM rk)
SELECT method, round(avg(rank), 6) AS mean_rank, CAST(max(k) AS BIGINT) AS k, CAST(max(nb) AS BIGINT) AS n_blocks,
  round(max({Q_SQL}[k] * sqrt(k * (k + 1) / (6.0 * nb))), 6) AS cd FROM rk, kn GROUP BY method""")
def q_nemenyi_cd(spark, sf):
    cd = CMP.nemenyi_cd(_ranks(spark, sf))
    return cd.select("method", rnd("mean_rank").alias("mean_rank"), F.col("k").cast("bigint"),
                     F.col("n_blocks").cast("bigint"), rnd("cd").alias("cd"))


@register("nemenyi_groups", f"""WITH RECURSIVE {PART_FOLDS_SQL}, {PART_RULES_SQL}, {RANKS_SQL},
kn AS (SELECT count(DISTINCT method) AS k, count(DISTINCT fold) AS nb FROM rk),
cdt AS (SELECT method, avg(rank) AS mean_rank, max({Q_SQL}[k] * sqrt(k * (k + 1) / (6.0 * nb))) AS cd FROM rk, kn GROUP BY method),
srt AS (SELECT method, mean_rank, cd, row_number() OVER (ORDER BY mean_rank, method) AS i FROM cdt),
walk(i, start_rank, grp) AS (
  SELECT 1, (SELECT mean_rank FROM srt WHERE i = 1), 1
  UNION ALL
  SELECT s.i, CASE WHEN s.mean_rank - w.start_rank > s.cd + 1e-12 THEN s.mean_rank ELSE w.start_rank END,
    CASE WHEN s.mean_rank - w.start_rank > s.cd + 1e-12 THEN w.grp + 1 ELSE w.grp END
  FROM walk w JOIN srt s ON s.i = w.i + 1)
SELECT s.method, round(s.mean_rank, 6) AS mean_rank, CAST(w.grp AS INTEGER) AS grp FROM walk w JOIN srt s ON s.i = w.i""")
def q_nemenyi_groups(spark, sf):
    g = CMP.nemenyi_groups(CMP.nemenyi_cd(_ranks(spark, sf)))
    return g.select("method", rnd("mean_rank").alias("mean_rank"), "grp")


@register("ordinal_rank", f"""WITH {EMB_BASE}
SELECT row_id, CAST(pos AS BIGINT) AS pos, CAST(row_number() OVER (PARTITION BY pos ORDER BY x, row_id) AS BIGINT) AS rank FROM ex""")
def q_ordinal_rank(spark, sf):
    from foldwise.operators.ranking import ordinal_rank
    lg = dt.embeddings(spark, sf).select("row_id", F.posexplode("features").alias("pos", "x"))
    r = ordinal_rank(lg, "pos", "x", "row_id")
    return r.select("row_id", F.col("pos").cast("bigint"), F.col("rank").cast("bigint"))


# ================================================================ G: scoring
@register("kendall_score", f"""WITH {LI_LONG_SQL},
cnt AS (SELECT feature, x, cls, count(*) AS n FROM lg GROUP BY ALL),
full_ AS (SELECT v.feature, v.x, c.cls, coalesce(cnt.n, 0) AS n FROM (SELECT DISTINCT feature, x FROM cnt) v
  CROSS JOIN (SELECT DISTINCT cls FROM lg) c LEFT JOIN cnt ON cnt.feature = v.feature AND cnt.x = v.x AND cnt.cls = c.cls),
bl AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY feature, cls ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM full_),
lw AS (SELECT *, coalesce(sum(below) OVER (PARTITION BY feature, x ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below_lower FROM bl),
cc AS (SELECT feature, sum(n * below_lower) AS conc, CAST(sum(n) AS DOUBLE) AS nr FROM lw GROUP BY feature)
SELECT feature, round((2 * conc - nr * (nr - 1) / 2) / (0.5 * nr * nr), 6) AS score FROM cc""")
def q_kendall(spark, sf):
    return G.kendall_score(_lineitem_long(spark, sf)).select("feature", rnd("score").alias("score"))


@register("anova_score", f"""WITH {LI_LONG_SQL},
per AS (SELECT feature, cls, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM lg GROUP BY ALL),
tot AS (SELECT feature, avg(x) AS mu FROM lg GROUP BY ALL),
a AS (SELECT per.feature, sum(n * (m - mu) * (m - mu)) AS ssb, sum(n * v) AS ssw FROM per JOIN tot ON per.feature = tot.feature GROUP BY ALL)
SELECT feature, round(CASE WHEN ssw = 0 THEN NULL ELSE ssb / ssw END, 6) AS score FROM a""")
def q_anova(spark, sf):
    return G.anova_ratio(_lineitem_long(spark, sf)).select("feature", rnd("score").alias("score"))


@register("pearson_score", f"""WITH {LI_LONG_SQL}
SELECT feature, round(CASE WHEN stddev_pop(x) * stddev_pop(CAST(cls AS DOUBLE)) = 0 THEN NULL
  ELSE covar_pop(x, CAST(cls AS DOUBLE)) / (stddev_pop(x) * stddev_pop(CAST(cls AS DOUBLE))) END, 6) AS score FROM lg GROUP BY feature""")
def q_pearson(spark, sf):
    return G.pearson_score(_lineitem_long(spark, sf)).select("feature", rnd("score").alias("score"))


EMB_LONG_SQL = f"""{EMB_BASE},
lg AS (SELECT row_id, CAST(label AS INTEGER) + 1 AS cls, 'x' || CAST(pos + 1 AS VARCHAR) AS feature, x FROM ex)"""


@register("spearman_score", f"""WITH {EMB_LONG_SQL},
rk AS (SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY x, row_id) AS DOUBLE) AS rx,
  CAST(row_number() OVER (PARTITION BY feature ORDER BY cls, row_id) AS DOUBLE) AS ry FROM lg)
SELECT feature, round(CASE WHEN stddev_pop(rx) * stddev_pop(ry) = 0 THEN NULL
  ELSE covar_pop(rx, ry) / (stddev_pop(rx) * stddev_pop(ry)) END, 6) AS score FROM rk GROUP BY feature""")
def q_spearman(spark, sf):
    lg = G.vector_to_long(dt.embeddings(spark, sf), classes=[str(i) for i in range(10)])
    return G.spearman_score(lg).select("feature", rnd("score").alias("score"))


@register("mutual_information", f"""WITH {LI_LONG_SQL},
st AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM lg GROUP BY ALL),
c AS (SELECT lg.feature, CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / (hi - lo) * 10), 9) END AS bin, cls, count(*) AS n
  FROM lg JOIN st ON st.feature = lg.feature GROUP BY ALL),
c2 AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS nn, sum(n) OVER (PARTITION BY feature, bin) AS nb,
  sum(n) OVER (PARTITION BY feature, cls) AS nc FROM c)
SELECT feature, round(sum((CAST(n AS DOUBLE) / nn) * ln((CAST(n AS DOUBLE) * nn) / (CAST(nb AS DOUBLE) * nc))), 6) AS score
FROM c2 GROUP BY feature""")
def q_mutual_information(spark, sf):
    return G.mutual_information(_lineitem_long(spark, sf), 10).select("feature", rnd("score").alias("score"))


@register("prune_columns", """WITH lg AS (SELECT CASE WHEN p_size > 25 THEN 0 ELSE 1 END AS cls, 'p_size' AS feature, CAST(p_size AS DOUBLE) AS x FROM part
  UNION ALL SELECT CASE WHEN p_size > 25 THEN 0 ELSE 1 END, 'p_retailprice', p_retailprice FROM part),
sc AS (SELECT feature, CASE WHEN stddev_pop(x) * stddev_pop(CAST(cls AS DOUBLE)) = 0 THEN NULL
  ELSE covar_pop(x, CAST(cls AS DOUBLE)) / (stddev_pop(x) * stddev_pop(CAST(cls AS DOUBLE))) END AS score FROM lg GROUP BY feature)
SELECT feature FROM sc WHERE score IS NOT NULL AND abs(score) >= 0.1""")
def q_prune_columns(spark, sf):
    p = table(spark, sf, "part").select("p_size", "p_retailprice", (F.col("p_size") > 25).cast("string").alias("label"))
    lg = G.to_long(p, ["p_size", "p_retailprice"], "label", classes=["false", "true"])
    return G.prune_columns(G.pearson_score(lg), "pearson")


# ================================================================ W: streams
from foldwise.streaming import prequential as W  # noqa: E402

WIN, BAT, KNN_K = 1000, 500, 9


def _stream_table(spark, sf, with_total: bool = False):
    """events ordered by (ts, event_id) -> seq, features (value, sin/cos
    hour with fitted cyclical parameters), label purchase."""
    ev = dt.events(spark, sf).withColumn("ts_key", ts_micros("ts"))
    s = SP.row_seq(ev, "ts_key", "event_id", total="_n" if with_total else None)
    cyc = P.cyclical_fit(dt.events(spark, sf), "hour")  # fitted on the plain scan
    out = W.stream_features(s, cyc, ["value"])
    return out.select("event_id", "seq", "features", F.col("label").cast("string").alias("label"),
                      *(["_n"] if with_total else []))


STREAM_SQL = CYCLIC_SQL.replace("WITH h AS (SELECT event_id, CAST(hour(ts) AS DOUBLE) AS hr FROM events)",
                                "WITH h AS (SELECT event_id, ts, value, event_type, CAST(hour(ts) AS DOUBLE) AS hr FROM events)") + """,
cy2 AS (SELECT h.event_id, h.ts, h.value, h.event_type, cy.s, cy.c FROM h JOIN cy ON cy.event_id = h.event_id),
feat AS (SELECT CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS seq, event_id,
  CAST(event_type = 'purchase' AS VARCHAR) AS label, round(value, 9) AS f1, round(s, 9) AS f2, round(c, 9) AS f3 FROM cy2)"""


@register("stream_layout", f"""WITH s AS ({EVENTS_SEQ_SQL})
SELECT event_id, seq, CAST(CASE WHEN seq < {WIN} THEN -1 ELSE (seq - {WIN}) // {BAT} END AS BIGINT) AS batch FROM s""")
def q_stream_layout(spark, sf):
    return W.stream_layout(_events_seq(spark, sf), WIN, BAT).select("event_id", "seq", "batch")


@register("stream_memory", f"""WITH s AS ({EVENTS_SEQ_SQL}),
b AS (SELECT DISTINCT (seq - {WIN}) // {BAT} AS batch FROM s WHERE seq >= {WIN})
SELECT CAST(b.batch AS BIGINT) AS batch, count(*) AS n_memory, min(s.seq) AS first_seq, max(s.seq) AS last_seq
FROM b JOIN s ON s.seq >= b.batch * {BAT} AND s.seq < b.batch * {BAT} + {WIN} GROUP BY b.batch""")
def q_stream_memory(spark, sf):
    return W.memory_summary(_events_seq(spark, sf), WIN, BAT)


@register("stream_features", STREAM_SQL + """
SELECT event_id, seq, label, round(f1, 6) AS f1, round(f2, 6) AS f2, round(f3, 6) AS f3 FROM feat""")
def q_stream_features(spark, sf):
    t = _stream_table(spark, sf)
    return t.select("event_id", "seq", "label", *[rnd(F.col("features")[i]).alias(f"f{i + 1}") for i in range(3)])


@register("prequential_knn", STREAM_SQL + f""",
qb AS (SELECT seq, label, f1, f2, f3, (seq - {WIN}) // {BAT} AS batch FROM feat WHERE seq >= {WIN}),
pr AS (SELECT q.seq AS qid, q.batch, q.label AS actual, m.seq AS did, m.label AS ml,
  round((q.f1 - m.f1) * (q.f1 - m.f1) + (q.f2 - m.f2) * (q.f2 - m.f2) + (q.f3 - m.f3) * (q.f3 - m.f3), 9) AS d2
  FROM qb q JOIN feat m ON m.seq >= q.batch * {BAT} AND m.seq < q.batch * {BAT} + {WIN}),
rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, did) AS rk FROM pr),
v AS (SELECT qid, batch, actual, ml, count(*) AS votes, max(rk) AS last FROM rk WHERE rk <= {KNN_K} GROUP BY ALL),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, last) AS r1 FROM v) WHERE r1 = 1)
SELECT CAST(batch AS BIGINT) AS batch, count(*) AS n, CAST(sum(CASE WHEN ml = actual THEN 1 ELSE 0 END) AS BIGINT) AS n_right,
  round(avg(CASE WHEN ml = actual THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p GROUP BY batch""")
def q_prequential_knn(spark, sf):
    r = W.prequential_knn(_stream_table(spark, sf, with_total=True), WIN, BAT, KNN_K, dim=3)
    return r.select("batch", "n", "n_right", rnd("accuracy").alias("accuracy"))


@register("prequential_svm")
def q_prequential_svm(spark, sf):
    r = W.prequential_svm(_stream_table(spark, sf, with_total=True), WIN, BAT, kind="rbf", C=1.0, gamma=2.0, dim=3)
    return r.select("batch", "n", "n_right", rnd("accuracy").alias("accuracy"))


# ================================================================ C5, M1, M10, M12
from foldwise.operators import neighbors as NB  # noqa: E402

EMB_SPLIT_SQL = f"""sp AS (SELECT row_id, label, CASE WHEN (row_number() OVER (ORDER BY {S.fold_key('row_id')}, row_id) - 1)
  < round_even(count(*) OVER () * 0.2, 0) THEN 'test' ELSE 'train' END AS split FROM base)"""


def _emb_split(spark, sf):
    return SP.hold_out(dt.embeddings(spark, sf), 0.2)


@register("knn_join", f"""WITH {EMB_BASE}, {EMB_SPLIT_SQL},
d AS (SELECT q.row_id AS qid, t.row_id AS did, round(sum((q.x - t.x) * (q.x - t.x)), 9) AS d2
  FROM ex q JOIN ex t ON q.pos = t.pos JOIN sp sq ON sq.row_id = q.row_id JOIN sp st ON st.row_id = t.row_id
  WHERE sq.split = 'test' AND st.split = 'train' GROUP BY ALL),
r AS (SELECT qid, did, d2, row_number() OVER (PARTITION BY qid ORDER BY d2, did) AS rk FROM d)
SELECT qid AS query_id, CAST(rk AS INTEGER) AS rank, did AS data_id, round(sqrt(d2), 6) AS dist FROM r WHERE rk <= 3""")
def q_knn_join(spark, sf):
    d = _emb_split(spark, sf)
    j = NB.knn_join(d.where("split = 'test'"), d.where("split = 'train'"), 3, carry=())
    return j.select("query_id", "rank", "data_id", rnd(F.sqrt("dist2")).alias("dist"))


def _knn_classify_sql(k):
    knn, out = S.knn_ctes("ex", "sp", k, "lq.split = 'test' AND ld.split = 'train'")
    return f"""WITH {EMB_BASE}, {EMB_SPLIT_SQL},
{knn}
SELECT p.row_id, s.label AS actual, p.predicted FROM {out} p JOIN sp s ON s.row_id = p.row_id"""


@register("knn_classify", _knn_classify_sql(5))
def q_knn_classify(spark, sf):
    d = _emb_split(spark, sf)
    te = d.where("split = 'test'")
    p = NB.knn_classify(d.where("split = 'train'"), te, 5)
    return te.select("row_id", F.col("label").alias("actual")).join(p, "row_id")


@register("bagging_knn", f"""WITH {EMB_BASE}, {EMB_SPLIT_SQL},
mem AS (SELECT * FROM range(3) t(member)),
tr AS (SELECT m.member, s.row_id, s.label FROM sp s, mem m WHERE s.split = 'train'
  AND CAST(('0x' || substr(md5('42:' || CAST(m.member AS VARCHAR) || ':' || CAST(s.row_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.5),
te AS (SELECT row_id FROM sp WHERE split = 'test'),
d AS (SELECT t.member, q.row_id AS qid, t.row_id AS did, t.label, round(sum((eq.x - et.x) * (eq.x - et.x)), 9) AS d2
  FROM te q JOIN ex eq ON eq.row_id = q.row_id, tr t JOIN ex et ON et.row_id = t.row_id
  WHERE eq.pos = et.pos GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY member, qid ORDER BY d2, did) AS rk FROM d),
v AS (SELECT member, qid, label, count(*) AS votes, max(rk) AS last FROM r WHERE rk <= 5 GROUP BY ALL),
mv AS (SELECT member, qid, label FROM (SELECT *, row_number() OVER (PARTITION BY member, qid ORDER BY votes DESC, last) AS r1 FROM v) WHERE r1 = 1),
c AS (SELECT qid, label, count(*) AS n FROM mv GROUP BY ALL)
SELECT qid AS row_id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY n DESC, label) AS r2 FROM c) WHERE r2 = 1""")
def q_bagging_knn(spark, sf):
    d = _emb_split(spark, sf)
    return NB.bagging_knn_predictions(d.where("split = 'train'"), d.where("split = 'test'"), 5, 3, 0.5)


@register("local_svm")
def q_local_svm(spark, sf):
    p = dt.part(spark, sf)
    p = SP.hold_out(p, 0.2)
    te = p.where("split = 'test'")
    pred = NB.local_svm_predictions(p.where("split = 'train'"), te, 7, C=1.0)
    return te.select("row_id", F.col("label").alias("actual")).join(pred, "row_id")


# ============================================== M: classifiers, V: evaluation
from foldwise.operators import models as MD  # noqa: E402
from foldwise.operators import reduce as RD  # noqa: E402
from foldwise.plans import evaluate as EV  # noqa: E402

PART_CLASSES = ["false", "true"]


def _part_folds(spark, sf, k=5):
    """part: separable label p_size > 25, features scaled to [0, 1]."""
    p = dt.part(spark, sf)
    p = P.minmax_fit(p).transform(p)
    return SP.stratified_kfold(p, k)


def _cv_rows(res: EV.CVResult, model: str) -> DataFrame:
    return rounded_summary(res.summary).withColumn("model", F.lit(model))


@register("cv_decision_tree")
def q_cv_decision_tree(spark, sf):
    res = EV.cross_validate(_part_folds(spark, sf), lambda tr: MD.decision_tree(tr, 4, PART_CLASSES), classes=PART_CLASSES)
    return _cv_rows(res, "tree_depth4")


@register("cv_svm_linear")
def q_cv_svm_linear(spark, sf):
    res = EV.cross_validate(_part_folds(spark, sf), lambda tr: MD.svm(tr, "linear", 1.0, classes=PART_CLASSES),
                            classes=PART_CLASSES)
    return _cv_rows(res, "svm_linear")


@register("cv_svm_rbf")
def q_cv_svm_rbf(spark, sf):
    res = EV.cross_validate(_part_folds(spark, sf), lambda tr: MD.svm(tr, "rbf", 1.0, gamma=3.0, classes=PART_CLASSES,
                                                                      n_landmarks=100), classes=PART_CLASSES)
    return _cv_rows(res, "svm_rbf_nystroem")


@register("svm_support_rows")
def q_svm_support_rows(spark, sf):
    p = _part_folds(spark, sf)
    m = MD.svm(p, "linear", 1.0, classes=PART_CLASSES)
    return MD.svm_support_rows(m, p)


@register("svm_incremental")
def q_svm_incremental(spark, sf):
    p = _part_folds(spark, sf).withColumn("batch", F.col("fold"))
    model, support, steps = MD.svm_incremental(p, "batch", C=1.0)
    pred = model.predict(p).join(p.select("row_id", F.col("label").alias("actual")), "row_id")
    return M.accuracy(pred, "actual", "predicted").select(rnd("accuracy").alias("accuracy"),
                                                           F.lit(len(steps)).alias("n_steps"))


@register("gradient_boosting")
def q_gradient_boosting(spark, sf):
    o = dt.orders(spark, sf).withColumn("features", F.array(F.col("features")[0], F.col("grp").cast("double")))
    o = SP.hold_out(o, 0.2)
    classes = P.class_list(o, "label")
    r = EV.train_test_eval(o.where("split = 'train'"), o.where("split = 'test'"),
                           lambda tr: MD.gradient_boosting(tr, 5, 0.2, 3, classes), classes=classes)
    return _round_metrics(r, cells=["n"])


@register("mlp_lbfgs")
def q_mlp_lbfgs(spark, sf):
    res = EV.cross_validate(_part_folds(spark, sf), lambda tr: MD.mlp_lbfgs(tr, [4], PART_CLASSES, 50),
                            classes=PART_CLASSES)
    return _cv_rows(res, "mlp_lbfgs_4")


@register("mlp_adam")
def q_mlp_adam(spark, sf):
    """Full-batch Adam with validation early stop; loss history rows."""
    p = SP.hold_out3(_part_folds(spark, sf), 0.2, 0.2)
    net = MD.train_network(p.where("split = 'train'"), [4], PART_CLASSES, ["relu"], max_epochs=30,
                           learning_rate=0.05, val=p.where("split = 'val'"), test=p.where("split = 'test'"),
                           max_epochs_val=5)
    h = net.history
    rows = [(i, float(h["train"][i]), float(h["val"][i]), float(h["test"][i])) for i in range(len(h["train"]))]
    return spark.createDataFrame(rows, "epoch int, train_loss double, val_loss double, test_loss double")


@register("cascade_network")
def q_cascade(spark, sf):
    p = _part_folds(spark, sf)
    net = MD.cascade_network(p, 2, PART_CLASSES, epochs_per_stage=8, learning_rate=0.05)
    pred = net.predict(p).join(p.select("row_id", F.col("label").alias("actual")), "row_id")
    return M.accuracy(pred, "actual", "predicted").select(
        rnd("accuracy").alias("accuracy"), F.lit(len(net.acts)).alias("hidden_units"))


@register("adaboost")
def q_adaboost(spark, sf):
    res = EV.cross_validate(_part_folds(spark, sf), lambda tr: MD.adaboost_stumps(tr, 5, PART_CLASSES),
                            classes=PART_CLASSES)
    return _cv_rows(res, "adaboost_stumps")


@register("rfe_logistic")
def q_rfe(spark, sf):
    li = table(spark, sf, "lineitem")
    kept = G.rfe_logistic(li, dt.LINEITEM_FEATURES, "l_returnflag", keep=2, max_iter=20)
    return spark.createDataFrame([(k,) for k in kept], "feature string")


@register("cv_ann_repeated")
def q_cv_ann_repeated(spark, sf):
    p = _part_folds(spark, sf, 3)

    def fit(tr, val, rep):
        return MD.train_network(tr, [3], PART_CLASSES, max_epochs=10, learning_rate=0.05, val=val,
                                max_epochs_val=3, seed=rep + 1)
    s = EV.cross_validate_repeated(p, fit, reps=2, validation_ratio=0.2, classes=PART_CLASSES)
    return s.select(F.col("n_folds").cast("bigint"), rnd("accuracy_mean").alias("accuracy_mean"),
                    rnd("accuracy_std").alias("accuracy_std"))


def _make_fit(model, params):
    if model == "tree":
        return lambda tr: MD.decision_tree(tr, params["max_depth"], PART_CLASSES)
    if model == "svm":
        return lambda tr: MD.svm(tr, params["kernel"], params["C"], gamma=params.get("gamma", 1.0),
                                 classes=PART_CLASSES, n_landmarks=50)
    if model == "knn":
        from foldwise.operators.neighbors import knn_classify
        k = params["k"]

        class _K:
            def __init__(self, tr):
                self.tr = tr

            def predict(self, te, id_col="row_id"):
                return knn_classify(self.tr, te, k)
        return _K
    raise ValueError(model)


SWEEP_CONFIGS = [("tree", {"max_depth": d}) for d in (1, 2, 4, 6)] + \
    [("knn", {"k": k}) for k in (1, 3)] + [("svm", {"kernel": "linear", "C": 1.0}), ("svm", {"kernel": "nope", "C": 1.0})]


@register("sweep")
def q_sweep(spark, sf):
    return EV.sweep(_part_folds(spark, sf, 3), SWEEP_CONFIGS, _make_fit, classes=PART_CLASSES)


@register("depth_impact")
def q_depth_impact(spark, sf):
    res = EV.sweep(_part_folds(spark, sf, 3), [("tree", {"max_depth": d}) for d in (2, 4, 6)], _make_fit,
                   classes=PART_CLASSES)
    sw = res.withColumn("max_depth", F.regexp_extract("params", r"(\d+)", 1).cast("int"))
    return CMP.depth_impact(sw)


@register("depth_impact_rule", f"""WITH {SWEEP_SQL}, s AS (SELECT 2 * (config_id + 1) AS max_depth, acc_mean FROM sweep WHERE model = 'size'),
j AS (SELECT t.max_depth AS depth_max, t.acc_mean AS acc_max, r.acc_mean AS acc_ref, (t.acc_mean - r.acc_mean) / t.acc_mean * 100 AS pct
  FROM s t, s r WHERE t.max_depth = (SELECT max(max_depth) FROM s) AND r.max_depth = 4)
SELECT CAST(depth_max AS INTEGER) AS depth_max, round(acc_max, 6) AS acc_max, round(acc_ref, 6) AS acc_ref, round(pct, 6) AS impact_pct,
  CASE WHEN pct > 5 THEN 'significant' WHEN pct > 0 THEN 'slight' ELSE 'none' END AS verdict FROM j""")
def q_depth_impact_rule(spark, sf):
    """V8's formula on accuracies of rules whose SQL twin is exact."""
    s = _sweep_results(spark, sf).where("model = 'size'").withColumn("max_depth", (2 * (F.col("config_id") + 1)).cast("int"))
    d = CMP.depth_impact(s)
    return d.select("depth_max", *[rnd(c).alias(c) for c in ["acc_max", "acc_ref", "impact_pct"]], "verdict")


@register("cv_ensemble")
def q_cv_ensemble(spark, sf):
    """V4: per fold, PCA(0.95) fitted on the training rows, then bagged kNN."""
    p = _part_folds(spark, sf, 3)

    def prepare(tr, te):
        pca = RD.pca_fit(tr, 2, threshold=0.95)
        return pca.transform(tr), pca.transform(te)

    class _Bag:
        def __init__(self, tr):
            self.tr = tr

        def predict(self, te, id_col="row_id"):
            return NB.bagging_knn_predictions(self.tr, te, 3, 3, 0.5)

    res = EV.cross_validate(p, _Bag, classes=PART_CLASSES, prepare=prepare)
    return _cv_rows(res, "pca95_bagging_knn")


@register("scored_pipeline")
def q_scored_pipeline(spark, sf):
    """V6: filter (Pearson keep-rule) -> PCA -> tree, fitted on train only."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), "o_totalprice", F.col("o_custkey").cast("double").alias("cust"),
        F.col("o_orderkey").cast("double").alias("okey"), (F.col("o_totalprice") > 150000).cast("string").alias("label"))
    o = SP.hold_out(o, 0.25)
    tr, te = o.where("split = 'train'"), o.where("split = 'test'")
    cols = ["o_totalprice", "cust", "okey"]
    kept = [r["feature"] for r in G.prune_columns(G.pearson_score(G.to_long(tr, cols, "label", PART_CLASSES)), "pearson").collect()]
    kept = [c for c in cols if c in kept] or cols
    tr = tr.withColumn("features", F.array(*kept))
    te = te.withColumn("features", F.array(*kept))
    sc = P.zscore_fit(tr)
    tr, te = sc.transform(tr), sc.transform(te)
    pca = RD.pca_fit(tr, len(kept), threshold=0.95)
    tr, te = pca.transform(tr), pca.transform(te)
    r = EV.train_test_eval(tr, te, lambda t: MD.decision_tree(t, 3, PART_CLASSES), classes=PART_CLASSES)
    return _round_metrics(r, cells=["n"]).withColumn("kept", F.lit(",".join(kept)))


# ================================================================ H: reduction
def _emb_projected(spark, sf, proj_fn):
    df = dt.embeddings(spark, sf)
    model = proj_fn(df)
    out = model.transform(df)
    return out.select("row_id", F.posexplode("features").alias("component", "score")) \
        .select("row_id", "component", rnd("score").alias("score"))


@register("pca_k")
def q_pca_k(spark, sf):
    return _emb_projected(spark, sf, lambda df: RD.pca_fit(df, 64, k=5))


@register("pca_threshold")
def q_pca_threshold(spark, sf):
    df = dt.embeddings(spark, sf)
    m = RD.pca_fit(df, 64, threshold=0.95)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(m.explained)], "component int, variance_ratio double")


@register("lda")
def q_lda(spark, sf):
    return _emb_projected(spark, sf, lambda df: RD.lda_fit(df, 64))


@register("fastica")
def q_fastica(spark, sf):
    return _emb_projected(spark, sf, lambda df: RD.fastica_fit(df, 64, n_components=4, max_iter=30))


@register("project_holdout")
def q_project_holdout(spark, sf):
    d = _emb_split(spark, sf)
    m = RD.pca_fit(d.where("split = 'train'"), 64, k=3)
    out = m.transform(d.where("split = 'test'"))
    return out.select("row_id", F.posexplode("features").alias("component", "score")) \
        .select("row_id", "component", rnd("score").alias("score"))


# ================================================================ patterns
from foldwise.operators import patterns as PT  # noqa: E402


def _emb_bits(spark, sf):
    df = dt.embeddings(spark, sf)
    return df.select("row_id", "label", P.binarize("features", 0.0).alias("pixels"))


def _bits_str(col):
    return F.array_join(F.transform(col, lambda x: F.when(x, "1").otherwise("0")), "")


@register("block_counts", f"""WITH {EMB_BASE}
SELECT row_id, CAST(pos // 8 // 2 AS INTEGER) AS by, CAST((pos % 8) // 2 AS INTEGER) AS bx,
  count(*) FILTER (WHERE x >= 0) AS n FROM ex GROUP BY ALL""")
def q_block_counts(spark, sf):
    return PT.block_counts(_emb_bits(spark, sf), 8, 2)


@register("random_patterns", """SELECT vec_id AS row_id, array_to_string(list_transform(range(0, 64),
  lambda i: CASE WHEN CAST(('0x' || substr(md5('42:' || CAST(vec_id AS VARCHAR) || ':' || CAST(i AS VARCHAR)), 1, 1)) AS INTEGER) % 2 = 0
  THEN '1' ELSE '0' END), '') AS bits FROM embeddings""")
def q_random_patterns(spark, sf):
    ids = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"))
    r = PT.random_patterns(ids, 64)
    return r.select("row_id", _bits_str(F.col("pixels")).alias("bits"))


@register("add_noise", f"""WITH {EMB_BASE},
px AS (SELECT row_id, pos, x >= 0 AS p, md5('42:' || CAST(row_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR)) AS h,
  CAST(row_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR) AS pid FROM ex),
rk AS (SELECT *, row_number() OVER (ORDER BY h, pid) - 1 AS r, count(*) OVER () AS n FROM px),
fl AS (SELECT row_id, pos, CASE WHEN r < round_even(n * 0.1, 0) THEN NOT p ELSE p END AS p FROM rk)
SELECT row_id, string_agg(CASE WHEN p THEN '1' ELSE '0' END, '' ORDER BY pos) AS bits FROM fl GROUP BY row_id""")
def q_add_noise(spark, sf):
    n = PT.add_noise(_emb_bits(spark, sf), 0.1)
    return n.select("row_id", _bits_str(F.col("pixels")).alias("bits"))


@register("exact_match", f"""WITH {EMB_BASE},
bits AS (SELECT row_id, label, list_transform(f, lambda x: x >= 0) AS px FROM base),
firsts AS (SELECT label, min(row_id) AS rid FROM base GROUP BY label),
tmpl AS (SELECT b.px, b.label, dense_rank() OVER (ORDER BY b.label) AS tno FROM bits b JOIN firsts f ON f.rid = b.row_id),
best AS (SELECT px, arg_max(label, tno) AS lab FROM tmpl GROUP BY px)
SELECT b.row_id, coalesce(best.lab, '-1') AS predicted FROM bits b LEFT JOIN best ON best.px = b.px""")
def q_exact_match(spark, sf):
    b = _emb_bits(spark, sf)
    firsts = ST.first_per_class(b.select("label", "row_id", "pixels"))
    from pyspark.sql import Window as _W
    tmpl = firsts.withColumn("template_no", F.dense_rank().over(_W.orderBy("label")))
    return PT.exact_match(b, tmpl)


@register("image_stack", """SELECT vec_id AS row_id, 8 AS h, 8 AS w, CAST(len(embedding) AS INTEGER) AS n_pixels FROM embeddings""")
def q_image_stack(spark, sf):
    b = _emb_bits(spark, sf).withColumn("h", F.lit(8)).withColumn("w", F.lit(8))
    s = PT.image_stack(b)
    return s.select("row_id", "h", "w", F.size("pixels").alias("n_pixels"))


@register("hopfield_recall")
def q_hopfield_recall(spark, sf):
    b = _emb_bits(spark, sf)
    w = PT.hopfield_weights_matrix(ST.hebbian_weights(
        b.select(F.transform("pixels", lambda x: F.when(x, 1.0).otherwise(-1.0)).alias("features")), 64), 64)
    noisy = PT.add_noise(b.select("row_id", "pixels"), 0.1)
    r = PT.hopfield_recall(noisy, w)
    return r.select("row_id", "steps", _bits_str(F.col("pixels")).alias("bits"))


@register("pattern_accuracy")
def q_pattern_accuracy(spark, sf):
    d = _emb_split(spark, sf).select("row_id", "label", F.col("features").alias("pixels"), "split")
    r = PT.pattern_accuracy(d.where("split = 'train'"), d.where("split = 'test'"), 0.0, 64)
    return r.select("split", rnd("accuracy").alias("accuracy"))


@register("prequential_isvm")
def q_prequential_isvm(spark, sf):
    """Incremental SVM over the events stream (W = 1000, B = 500); the
    support-row state is written to the shared folder at every step."""
    from foldwise.sources.files import scratch_path
    from foldwise.streaming.live import prequential_isvm
    import uuid
    base = scratch_path(spark, f"isvm-{uuid.uuid4().hex[:12]}")
    r = prequential_isvm(_stream_table(spark, sf), WIN, BAT, base, kind="rbf", C=1.0, gamma=2.0)
    return r.select("batch", "n", "n_right", rnd("accuracy").alias("accuracy"))


# ================================================================ A: sources
from foldwise.sources import files as FS  # noqa: E402


def _scratch(spark, name):
    import uuid
    return FS.scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("read_labelled", """SELECT CAST(p_size AS DOUBLE) AS x1, p_retailprice AS x2,
  CAST(p_size > 25 AS VARCHAR) AS label FROM part""")
def q_read_labelled(spark, sf):
    """A1 + A6: part written as a TSV with a 'target' column (written only
    if absent), read back as a labelled feature table."""
    path = _scratch(spark, "part-tsv")
    src = table(spark, sf, "part").select(F.col("p_size").cast("double").alias("size"), "p_retailprice",
                                           F.when(F.col("p_size") > 25, "yes").otherwise("no").alias("target"))
    FS.write_table(src, path, "tsv")
    df = FS.read_labelled(spark, path)
    return df.select(F.col("features")[0].alias("x1"), F.col("features")[1].alias("x2"), "label")


@register("read_folder", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority,
  CAST(year(o_orderdate) AS VARCHAR) AS yr FROM orders""")
def q_read_folder(spark, sf):
    """A2: orders split into one CSV per order year, the folder read back."""
    base = _scratch(spark, "orders-csv")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority",
                                           F.year("o_orderdate").cast("string").alias("yr"))
    years = sorted(r[0] for r in o.select("yr").distinct().collect())
    for y in years:
        o.where(F.col("yr") == y).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{base}/tmp_{y}")
        # flatten to <base>/<year>.CSV (mixed-case extension on purpose)
        jvm = spark.sparkContext._jvm
        fs = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        part = [s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{base}/tmp_{y}"))
                if s.getPath().getName().startswith("part-")][0]
        fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{base}/{y}.CSV" if int(y) % 2 else f"{base}/{y}.csv"))
    df = FS.read_folder(spark, base)
    return df.drop("_file_no")


@register("read_matrix", f"""WITH {EMB_BASE}
SELECT row_id, label, round(list_sum(f), 6) AS s FROM base""")
def q_read_matrix(spark, sf):
    """A3: embeddings as a headerless CSV (64 features + label)."""
    path = _scratch(spark, "emb-csv")
    e = dt.embeddings(spark, sf)
    e = e.repartitionByRange(5, "row_id").sortWithinPartitions("row_id")  # part files of unequal sizes, in row order
    e.select(*[F.col("features")[i] for i in range(64)], "label").write.csv(path)
    m = FS.read_matrix(spark, path, 64)
    return m.select("row_id", "label", rnd(F.aggregate("features", F.lit(0.0), lambda a, x: a + x)).alias("s"))


@register("read_stream_files", f"""WITH s AS ({EVENTS_SEQ_SQL})
SELECT s.seq, round(e.value, 6) AS value, CAST(e.event_type = 'purchase' AS BOOLEAN) AS label
FROM s JOIN events e USING (event_id)""")
def q_read_stream_files(spark, sf):
    """A4: events written as two row-aligned text files (numbers separated
    by tabs/spaces/commas; labels UP/DOWN), read back and aligned by line."""
    base = _scratch(spark, "stream-txt")
    def parts(n):
        # n part files whose sizes grow, in stream order; data and labels are cut at different lines
        d = _events_seq(spark, sf).withColumn("_p", F.floor(F.sqrt(F.col("seq").cast("double")) / 40).cast("int") % 1000)
        return d.repartitionByRange(n, "_p").sortWithinPartitions("seq")

    row = F.concat_ws(" ", F.col("seq").cast("string"), F.lit("1"), F.lit("2"), F.col("value").cast("string"),
                      F.lit("0.5"), F.lit("0.1"), F.lit("0.2"), F.lit("0.3"))
    parts(4).select(row.alias("value")).write.text(f"{base}/x")
    parts(3).select(F.when(F.col("label"), "UP").otherwise("DOWN").alias("value")).write.text(f"{base}/y")
    r = FS.read_stream_files(spark, f"{base}/x", f"{base}/y")
    return r.select("seq", rnd(F.col("nswprice")).alias("value"), "label")


@register("load_filtered", """SELECT vec_id AS row_id, CAST(label AS VARCHAR) AS label FROM embeddings WHERE label IN (2, 8)""")
def q_load_filtered(spark, sf):
    return FS.load_filtered(dt.embeddings(spark, sf).select("row_id", "label"), ["2", "8"])


@register("load_filtered_relabel", """SELECT vec_id AS row_id,
  CASE WHEN label IN (2, 8) THEN CAST(label AS VARCHAR) ELSE '-1' END AS label FROM embeddings""")
def q_load_filtered_relabel(spark, sf):
    return FS.load_filtered(dt.embeddings(spark, sf).select("row_id", "label"), ["2", "8", -1])


@register("knn_join_lsh")
def q_knn_join_lsh(spark, sf):
    """C5 approximate: LSH candidates, exact fallback for queries with fewer
    than k candidates; reports recall of the true neighbours per rank."""
    d = _emb_split(spark, sf)
    q, t = d.where("split = 'test'"), d.where("split = 'train'")
    approx = NB.knn_join_lsh(q, t, 3, bucket_length=2.0, threshold=4.0, num_tables=4, carry=())
    exact = NB.knn_join(q, t, 3, carry=())
    both = approx.select("query_id", "rank", F.col("data_id").alias("approx_id")).join(
        exact.select("query_id", "rank", F.col("data_id").alias("exact_id")), ["query_id", "rank"])
    return both.groupBy("rank").agg(F.count(F.lit(1)).alias("n"),
                                    rnd(F.avg((F.col("approx_id") == F.col("exact_id")).cast("double"))).alias("agree"))


@register("cv_svm_poly")
def q_cv_svm_poly(spark, sf):
    res = EV.cross_validate(_part_folds(spark, sf), lambda tr: MD.svm(tr, "poly", 100.0, gamma=1.0, degree=2,
                                                                      classes=PART_CLASSES, n_landmarks=100),
                            classes=PART_CLASSES)
    return _cv_rows(res, "svm_poly2_nystroem")


@register("cv_svm_sigmoid")
def q_cv_svm_sigmoid(spark, sf):
    res = EV.cross_validate(_part_folds(spark, sf), lambda tr: MD.svm(tr, "sigmoid", 1.0, gamma=0.5, coef0=0.0,
                                                                      classes=PART_CLASSES, n_landmarks=100),
                            classes=PART_CLASSES)
    return _cv_rows(res, "svm_sigmoid_nystroem")


@register("knn_cv_lsh")
def q_knn_cv_lsh(spark, sf):
    """Flagship with LSH candidates (the route for tables where exact
    all-pairs kNN is out of reach); rows-only check."""
    df = dt.embeddings(spark, sf)
    df = minmax_fit(df).transform(df)
    df = stratified_kfold(df, 5, seed=42)
    res = knn_cross_validate(df, 5, classes=[str(i) for i in range(10)],
                             lsh={"bucket_length": 2.0, "threshold": 4.0, "num_tables": 4})
    return rounded_summary(res.summary)

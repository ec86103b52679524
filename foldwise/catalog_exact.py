"""Registered queries of the exact and pruned operators, beside ``catalog``."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from foldwise.catalog import EMB_BASE, EMB_SPLIT_SQL, LI_LONG_SQL, ORACLE, STREAM_SQL, _emb_split, _knn_cv_fold_scaled_sql, _stream_table, register
from foldwise.functions.common import rnd, to_features, ts_micros
from foldwise.functions.prep import minmax_fit
from foldwise.operators import cascade_svm as CS
from foldwise.operators import neighbors as NB
from foldwise.operators import scoring as G
from foldwise.operators import splits as SP
from foldwise.operators import trees as TR
from foldwise.operators.splits import stratified_kfold
from foldwise.operators.voronoi import PrunedJoin
from foldwise.plans.evaluate import cross_validate, knn_cross_validate, rounded_summary, train_test_eval
from foldwise.session import cut_lineage, table
from foldwise.sources import driver_tables as dt

# ================================================================ C5, V1: pruned kNN
@register("knn_join_pruned", f"""WITH {EMB_BASE}, {EMB_SPLIT_SQL},
d AS (SELECT q.row_id AS qid, t.row_id AS did, t.label, round(sum((q.x - t.x) * (q.x - t.x)), 9) AS d2
  FROM ex q JOIN ex t ON q.pos = t.pos JOIN sp sq ON sq.row_id = q.row_id JOIN sp st ON st.row_id = t.row_id
  WHERE sq.split = 'test' AND st.split = 'train' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, did) AS rk FROM d)
SELECT qid AS query_id, CAST(rk AS INTEGER) AS rank, did AS data_id, label, round(sqrt(d2), 6) AS dist FROM r WHERE rk <= 7""")
def q_knn_join_pruned(spark, sf):
    """C5 over several data blocks: cells, rings, bounds from a first visit."""
    d = _emb_split(spark, sf)
    j = NB.knn_join(d.where("split = 'test'"), d.where("split = 'train'"), 7, block_rows=128)
    return j.select("query_id", "rank", "data_id", "label", rnd(F.sqrt("dist2")).alias("dist"))


PART_SCALED_SQL = """b AS (SELECT p_partkey AS row_id, CAST(p_size AS DOUBLE) AS s, CAST(p_retailprice AS DOUBLE) AS p FROM part),
m AS (SELECT min(s) AS s0, max(s) - min(s) AS s1, min(p) AS p0, max(p) - min(p) AS p1 FROM b),
f AS (SELECT row_id, CASE WHEN s1 = 0 THEN 0.0 ELSE (s - s0) / s1 END AS s, CASE WHEN p1 = 0 THEN 0.0 ELSE (p - p0) / p1 END AS p,
  (row_number() OVER (ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) - 1) < round_even(count(*) OVER () * 0.2, 0) AS test FROM b, m)"""


@register("knn_join_pruned_part", f"""WITH {PART_SCALED_SQL},
d AS (SELECT q.row_id AS qid, t.row_id AS did, round((q.s - t.s) * (q.s - t.s) + (q.p - t.p) * (q.p - t.p), 9) AS d2 FROM f q JOIN f t ON q.test AND NOT t.test),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, did) AS rk FROM d)
SELECT qid AS query_id, CAST(rk AS INTEGER) AS rank, did AS data_id, round(sqrt(d2), 6) AS dist FROM r WHERE rk <= 3""")
def q_knn_join_pruned_part(spark, sf):
    """C5 on few features, where most pairs of blocks are never visited; many equal distances."""
    d = dt.part(spark, sf)
    d = SP.hold_out(minmax_fit(d).transform(d), 0.2)
    j = NB.knn_join(d.where("split = 'test'"), d.where("split = 'train'"), 3, carry=(), block_rows=256)
    return j.select("query_id", "rank", "data_id", rnd(F.sqrt("dist2")).alias("dist"))


@register("knn_cv_pruned", _knn_cv_fold_scaled_sql(5, 5))
def q_knn_cv_pruned(spark, sf):
    """V1 with one scaler a fold, pruned: the radius table holds every fold's distances."""
    df = stratified_kfold(dt.embeddings(spark, sf), 5, seed=42)
    return rounded_summary(knn_cross_validate(df, 5, classes=[str(i) for i in range(10)], scale="per_fold", block_rows=128).summary)


@register("knn_pruning_report")
def q_knn_pruning_report(spark, sf):
    """Pairs of a query row and a data block that the bounds leave, over all orders (price and day)."""
    o = table(spark, sf, "orders")
    d = o.select(F.col("o_orderkey").alias("row_id"), to_features("o_totalprice", F.datediff("o_orderdate", F.lit("1990-01-01").cast("date"))).alias("features"))
    d = SP.hold_out(minmax_fit(d).transform(d), 0.2)
    q, t = d.where("split = 'test'"), d.where("split = 'train'")
    return PrunedJoin(q, t, 5, dim=2, n_data=t.count(), carry=(), block_rows=512).report()


# ================================================================ M3-M5: exact kernel SVM
def _part_bands(spark, sf):
    """Three classes by part size; features scaled to 0..1."""
    p = table(spark, sf, "part")
    d = p.select(F.col("p_partkey").alias("row_id"), to_features("p_size", "p_retailprice").alias("features"),
                 F.when(F.col("p_size") <= 17, "a").when(F.col("p_size") <= 34, "b").otherwise("c").alias("label"))
    return minmax_fit(d).transform(d)


def _kkt(model, d):
    k = CS.kkt_report(model, d)
    names = F.array(*[F.lit(f"{model.classes[i]}-{model.classes[j]}") for i, j in model.machines])
    return k.select(F.element_at(names, F.col("pair") + 1).alias("classes"), "n_rows", F.col("violations"), F.round("balance", 3).alias("balance"))


BANDS_SQL = """WITH n AS (SELECT CASE WHEN p_size <= 17 THEN 'a' WHEN p_size <= 34 THEN 'b' ELSE 'c' END AS c, count(*) AS n FROM part GROUP BY ALL)
SELECT x.c || '-' || y.c AS classes, x.n + y.n AS n_rows, CAST(0 AS BIGINT) AS violations, 0.0::DOUBLE AS balance FROM n x JOIN n y ON x.c < y.c"""


@register("svm_cascade_rbf", BANDS_SQL)
def q_svm_cascade_rbf(spark, sf):
    """M3 exact, rbf, one machine per pair: the optimality conditions hold on every row of each pair."""
    d = _part_bands(spark, sf)
    return _kkt(CS.cascade_svm(d, "rbf", 10.0, 4.0), d)


@register("svm_cascade_linear", BANDS_SQL)
def q_svm_cascade_linear(spark, sf):
    d = _part_bands(spark, sf)
    return _kkt(CS.cascade_svm(d, "linear", 10.0), d)


@register("svm_cascade_incremental")
def q_svm_cascade_incremental(spark, sf):
    """M5 with M4's split: support rows of every step, carried over and new."""
    d = _part_bands(spark, sf).withColumn("batch", F.pmod(F.xxhash64("row_id"), F.lit(4)))
    return CS.cascade_incremental(d, "rbf", 10.0, 4.0, classes=["a", "b", "c"])[2]


# ================================================================ W2, W3, W5: keyed streams
STREAMS, SWIN, SBAT, SK = 4, 200, 100, 5
#: rows of a source file
STREAM_FILE = 250_000


def _streams_source(spark, sf):
    """The events as four streams by user, every stream numbered by (ts, event_id), written as files of mixed streams."""
    from foldwise.operators.sequence import dense_seq
    from foldwise.sources.files import scratch_path

    t = _stream_table(spark, sf).join(table(spark, sf, "events").select("event_id", F.pmod("user_id", F.lit(STREAMS)).cast("string").alias("stream")), "event_id")
    t = dense_seq(t, [F.col("seq")], numeric_key="seq", group_cols=("stream",), name="pos", total="total")
    base = scratch_path(spark, f"streams-{uuid.uuid4().hex[:12]}")
    src = os.path.join(base, "src")
    rows = t.select("stream", F.col("pos").cast("long").alias("seq"), "features", "label", F.col("total").cast("long").alias("total"))
    # rows of all streams in every file, out of order; a file is a stretch of each stream, so that few rows wait for those before them
    rows = cut_lineage(rows)
    n = max(6, -(-rows.count() // STREAM_FILE))
    rows.repartitionByRange(n, F.col("seq") / F.col("total")).sortWithinPartitions(F.xxhash64("stream", "seq")).write.parquet(src)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(src), base


@register("prequential_knn_streams", STREAM_SQL + f""",
ks AS (SELECT f.*, CAST(e.user_id % {STREAMS} AS VARCHAR) AS stream, row_number() OVER (PARTITION BY e.user_id % {STREAMS} ORDER BY f.seq) - 1 AS pos
  FROM feat f JOIN events e ON e.event_id = f.event_id),
qb AS (SELECT *, (pos - {SWIN}) // {SBAT} AS batch FROM ks WHERE pos >= {SWIN}),
pr AS (SELECT q.stream, q.pos AS qid, q.batch, q.label AS actual, m.pos AS did, m.label AS ml,
  round((q.f1 - m.f1) * (q.f1 - m.f1) + (q.f2 - m.f2) * (q.f2 - m.f2) + (q.f3 - m.f3) * (q.f3 - m.f3), 9) AS d2
  FROM qb q JOIN ks m ON m.stream = q.stream AND m.pos >= q.batch * {SBAT} AND m.pos < q.batch * {SBAT} + {SWIN}),
rk AS (SELECT *, row_number() OVER (PARTITION BY stream, qid ORDER BY d2, did) AS rk FROM pr),
v AS (SELECT stream, qid, batch, actual, ml, count(*) AS votes, max(rk) AS last FROM rk WHERE rk <= {SK} GROUP BY ALL),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stream, qid ORDER BY votes DESC, last) AS r1 FROM v) WHERE r1 = 1)
SELECT stream, CAST(batch AS BIGINT) AS batch, count(*) AS n, CAST(sum(CASE WHEN ml = actual THEN 1 ELSE 0 END) AS BIGINT) AS n_right FROM p GROUP BY ALL""")
def q_prequential_knn_streams(spark, sf):
    """W2 and W3 for several streams at once, memories in the state store."""
    from foldwise.streaming import keyed as K

    source, base = _streams_source(spark, sf)
    r = K.run_streams(spark, source, K.KnnStream(SWIN, SBAT, SK), os.path.join(base, "out"), os.path.join(base, "ck"))
    return r.select("stream", "batch", "n", "n_right")


@register("prequential_isvm_streams")
def q_prequential_isvm_streams(spark, sf):
    """W5 for several streams at once, support rows and ages in the state store."""
    from foldwise.streaming import keyed as K

    source, base = _streams_source(spark, sf)
    r = K.run_streams(spark, source, K.SvmStream(SWIN, SBAT), os.path.join(base, "out"), os.path.join(base, "ck"))
    return r.select("stream", "batch", "n", "n_right", rnd("accuracy").alias("accuracy"))


@register("stream_guard", """WITH e AS (SELECT event_id, epoch_us(ts) AS t FROM events),
s AS (SELECT event_id, t, ntile(3) OVER (ORDER BY t, event_id) AS part FROM e),
m AS (SELECT part, max(t) AS top FROM s GROUP BY part)
SELECT CAST(count(*) AS BIGINT) AS n_accepted, CAST((SELECT count(*) FROM s WHERE part = 1) AS BIGINT) AS n_again FROM s""")
def q_stream_guard(spark, sf):
    """The guard over the events in three parts by time, the first part sent once more at the end: its rows are all late
    or repeated, none is accepted twice and none is lost."""
    from foldwise.sources.files import scratch_path
    from foldwise.streaming import guard as GU
    from foldwise.operators.sequence import dense_seq

    base = scratch_path(spark, f"guard-{uuid.uuid4().hex[:12]}")
    src = os.path.join(base, "src")
    ev = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).withColumn("k", ts_micros("ts"))
    ev = dense_seq(ev, [F.col("k"), F.col("event_id")], numeric_key="k", name="pos", total="n").drop("k")
    # the sizes of ntile(3): the first files hold one row more
    big, size = F.col("n") % 3, F.floor(F.col("n") / 3)
    part = F.when(F.col("pos") < big * (size + 1), F.floor(F.col("pos") / (size + 1))).otherwise(F.floor((F.col("pos") - big) / F.greatest(size, F.lit(1))))
    ev = ev.select("event_id", "ts", part.cast("int").alias("part"))
    for p in (0, 1, 2, 0):  # one micro-batch each
        ev.where(F.col("part") == p).select("event_id", "ts").write.mode("append").parquet(src)
        _, counts = GU.run_guard(spark, spark.readStream.schema("event_id long, ts timestamp").parquet(src), os.path.join(base, "g"), "ts", "event_id", 86400.0)
    return counts.agg(F.sum("n_accepted").alias("n_accepted"), F.sum(F.col("n_repeated") + F.col("n_late")).alias("n_again"))


# ================================================================ G1-G4 with missing values, average ranks
LI_MISSING_SQL = """li AS (SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS cls, l_orderkey * 8 + l_linenumber AS row_id,
  CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN l_linestatus = 'O' AND l_discount < 0.03 THEN NULL ELSE l_discount END AS l_discount, l_tax FROM lineitem),
lg AS (SELECT * FROM (SELECT row_id, cls, 'l_quantity' AS feature, l_quantity AS x FROM li UNION ALL SELECT row_id, cls, 'l_extendedprice', l_extendedprice FROM li
  UNION ALL SELECT row_id, cls, 'l_discount', l_discount FROM li UNION ALL SELECT row_id, cls, 'l_tax', l_tax FROM li) WHERE x IS NOT NULL)"""


def _lineitem_missing(spark, sf):
    li = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"), F.col("l_returnflag").alias("label"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(~((F.col("l_linestatus") == "O") & (F.col("l_discount") < 0.03)), F.col("l_discount")).alias("l_discount"), "l_tax")
    return G.to_long(li, dt.LINEITEM_FEATURES, "label", id_col="row_id")


def _missing_twin(name: str) -> str:
    """The twin of a score over all rows, with its rows taken from the table with missing values."""
    sql = ORACLE[name]
    if LI_LONG_SQL not in sql:
        raise ValueError(name)
    return sql.replace(LI_LONG_SQL, LI_MISSING_SQL)


@register("kendall_score_missing", _missing_twin("kendall_score"))
def q_kendall_missing(spark, sf):
    return G.kendall_score(_lineitem_missing(spark, sf)).select("feature", rnd("score").alias("score"))


@register("anova_score_missing", _missing_twin("anova_score"))
def q_anova_missing(spark, sf):
    return G.anova_ratio(_lineitem_missing(spark, sf)).select("feature", rnd("score").alias("score"))


@register("pearson_score_missing", _missing_twin("pearson_score"))
def q_pearson_missing(spark, sf):
    return G.pearson_score(_lineitem_missing(spark, sf)).select("feature", rnd("score").alias("score"))


SPEARMAN_SQL = """SELECT feature, round(CASE WHEN stddev_pop(rx) * stddev_pop(ry) = 0 THEN NULL
  ELSE covar_pop(rx, ry) / (stddev_pop(rx) * stddev_pop(ry)) END, 6) AS score FROM rk GROUP BY feature"""


@register("spearman_score_missing", f"""WITH o AS (SELECT o_orderkey AS row_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS cls,
  CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 20 AS DOUBLE) END AS cust FROM orders),
lg AS (SELECT * FROM (SELECT row_id, cls, 'price' AS feature, price AS x FROM o UNION ALL SELECT row_id, cls, 'cust', cust FROM o) WHERE x IS NOT NULL),
rk AS (SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY x, row_id) AS DOUBLE) AS rx,
  CAST(row_number() OVER (PARTITION BY feature ORDER BY cls, row_id) AS DOUBLE) AS ry FROM lg)
{SPEARMAN_SQL}""")
def q_spearman_missing(spark, sf):
    """G4, ties by row position: five classes and twenty values of one feature, so most rows tie."""
    lg = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS row_id", "CAST(substr(o_orderpriority, 1, 1) AS INT) AS cls",
        "stack(2, 'price', CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_totalprice AS DOUBLE) END, 'cust', CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 20 AS DOUBLE) END) AS (feature, x)")
    return G.spearman_score(lg).select("feature", rnd("score").alias("score"))


@register("spearman_average_ties", f"""WITH {LI_MISSING_SQL},
rk AS (SELECT feature, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY feature ORDER BY cls) + (count(*) OVER (PARTITION BY feature, cls) - 1) / 2.0 AS ry FROM lg)
{SPEARMAN_SQL}""")
def q_spearman_average(spark, sf):
    return G.spearman_score(_lineitem_missing(spark, sf), ties="average").select("feature", rnd("score").alias("score"))


# ================================================================ M2, M13, V4: trees
def _orders_classes(spark, sf):
    """Five classes; a continuous feature and one of twenty values, missing in every fifth row."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS row_id", "array(CAST(o_totalprice AS DOUBLE), CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 20 AS DOUBLE) END) AS features",
        "substr(o_orderpriority, 1, 1) AS label")


@register("exact_tree_root", """WITH o AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS c, CAST(o_totalprice AS DOUBLE) AS f0,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey % 20 AS DOUBLE) END AS f1 FROM orders),
lg AS (SELECT * FROM (SELECT 0 AS f, f0 AS x, c FROM o UNION ALL SELECT 1, f1, c FROM o) WHERE x IS NOT NULL),
v AS (SELECT f, x, c, count(*) AS n FROM lg GROUP BY ALL),
g AS (SELECT DISTINCT f, x FROM v), k AS (SELECT DISTINCT c FROM v),
w AS (SELECT g.f, g.x, k.c, coalesce(v.n, 0) AS n FROM g CROSS JOIN k LEFT JOIN v ON v.f = g.f AND v.x = g.x AND v.c = k.c),
r AS (SELECT f, x, c, CAST(sum(n) OVER (PARTITION BY f, c ORDER BY x) AS DOUBLE) AS l, CAST(sum(n) OVER (PARTITION BY f, c) AS DOUBLE) AS t FROM w),
s AS (SELECT f, x, sum(l) AS nl, sum(t) - sum(l) AS nr, sum(l * l) AS ll, sum((t - l) * (t - l)) AS rr, sum(t * t) AS tt, sum(t) AS nt FROM r GROUP BY f, x),
b AS (SELECT *, round((ll / nl + rr / nr) / nt, 12) AS score, lead(x) OVER (PARTITION BY f ORDER BY x) AS above FROM (SELECT * FROM s WHERE nl > 0)
), p AS (SELECT * FROM b WHERE nr > 0)
SELECT f AS feature, round(x, 6) AS value, round(above, 6) AS above, CAST(nl AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right,
  round(score, 9) AS score, round(tt / (nt * nt), 9) AS base FROM p ORDER BY p.score DESC, f, x LIMIT 1""")
def q_exact_tree_root(spark, sf):
    """M2: the root's split over all distinct values."""
    rows = _orders_classes(spark, sf).select("features", F.lit(1).cast("long").alias("node"), (F.col("label").cast("int") - 1).alias("y"))
    return TR.split_table(rows, 2, 5).select("feature", rnd("value").alias("value"), rnd("above").alias("above"), "n_left", "n_right", rnd("score", 9).alias("score"), rnd("base", 9).alias("base"))


@register("exact_tree_eval")
def q_exact_tree_eval(spark, sf):
    d = SP.hold_out(dt.part(spark, sf), 0.2)
    r = train_test_eval(d.where("split = 'train'"), d.where("split = 'test'"), lambda tr: TR.exact_tree(tr, 2, ["false", "true"]), classes=["false", "true"])
    return r.select([rnd(c).alias(c) for c in r.columns if c not in ("fold",)])


@register("softmax_boosting")
def q_softmax_boosting(spark, sf):
    """Ten classes, ten trees a round."""
    classes = [str(i) for i in range(10)]
    d = SP.hold_out(dt.embeddings(spark, sf), 0.2)
    r = train_test_eval(d.where("split = 'train'"), d.where("split = 'test'"), lambda tr: TR.softmax_boosting(tr, 3, 0.3, 3, classes, bins=32), classes=classes)
    return r.select([rnd(c).alias(c) for c in r.columns if c not in ("fold",)])


@register("cv_softmax_boosting")
def q_cv_softmax_boosting(spark, sf):
    """V4: boosted trees in the fold loop."""
    d = SP.stratified_kfold(dt.part(spark, sf), 3)
    return rounded_summary(cross_validate(d, lambda tr: TR.softmax_boosting(tr, 3, 0.3, 2, ["false", "true"], bins=32), classes=["false", "true"]).summary)

"""Scores over columns with missing values, and ranks whose ties are cut."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import ranking as R
from foldwise.operators import scoring as G

SCHEMA = "row_id long, feature string, x double, cls int"
SCORES = {"kendall": G.kendall_score, "anova": G.anova_ratio, "pearson": G.pearson_score, "order": G.spearman_score,
          "average": lambda d: G.spearman_score(d, ties="average")}


def _rows(n=90):
    rng = np.random.default_rng(8)
    return [(i, f, float(rng.integers(0, 7)) + (i % 3 if f == "a" else 0), i % 3 + 1) for i in range(n) for f in "ab"]


@pytest.mark.parametrize("name", SCORES)
def test_missing_rows_count_as_absent(spark, name):
    rows = _rows()
    holes = [(1000 + i, f, v, c) for i, (f, v, c) in enumerate([("a", None, 1), ("a", None, 3), ("b", math.nan, 2), ("b", 2.0, None), ("none", None, 1), ("none", None, 2)] * 4)]
    plain = {r.feature: r.score for r in SCORES[name](spark.createDataFrame(rows, SCHEMA)).collect()}
    mixed = {r.feature: r.score for r in SCORES[name](spark.createDataFrame(rows + holes, SCHEMA)).collect()}
    assert set(mixed) == {"a", "b"}
    assert all(abs(mixed[f] - plain[f]) < 1e-12 for f in plain)


def test_average_ties_match_numpy(spark):
    rows = _rows()
    got = {r.feature: r.score for r in G.spearman_score(spark.createDataFrame(rows, SCHEMA), ties="average").collect()}

    def ranks(v):
        return np.array([(v < u).sum() + ((v == u).sum() + 1) / 2 for u in v])

    for f in "ab":
        x = np.array([r[2] for r in rows if r[1] == f])
        y = np.array([r[3] for r in rows if r[1] == f])
        assert abs(got[f] - np.corrcoef(ranks(x), ranks(y))[0, 1]) < 1e-12
    constant = [(i, "a", 1.0, i % 2) for i in range(9)]
    assert G.spearman_score(spark.createDataFrame(constant, SCHEMA), ties="average").first().score is None
    assert G.spearman_score(spark.createDataFrame([], SCHEMA), ties="average").count() == 0


@pytest.mark.parametrize("groups", [["g", "h", None], [f"g{k}" for k in range(120)]])
def test_frequent_value_is_cut_by_its_ties(spark, groups):
    """Half of a group's rows hold one value; with many groups the bounds go through a map instead of literals."""
    per = 600 if len(groups) < 10 else 32
    rows = [((i * 7919) % 100_003 + 200_000 * j, g, 3.0 if i % 2 else float(i % 11)) for j, g in enumerate(groups) for i in range(per)]
    d = spark.createDataFrame(rows, "row_id long, feature string, x double")
    d = d.where("feature is not null")
    got = {(r.feature, r.row_id): r["rank"] for r in R.ordinal_rank(d, "feature", "x", "row_id").collect()}
    want = {}
    for g in groups:
        if g is not None:
            for k, (i, _, _) in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))):
                want[g, i] = k + 1
    assert got == want
    b = R.bucketed(d, "feature", "x", ["row_id"], 8)
    sizes = b.where("x = 3").groupBy("feature", "_rs_b", "_rs_tb").agg(F.count("*").alias("n")).groupBy("feature").agg(F.count("*").alias("k"), F.max("n").alias("most")).collect()
    assert all(r.k >= 6 and r.most <= per / 4 for r in sizes)

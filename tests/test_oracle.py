"""A slice of the correctness gate inside pytest: registered queries against
their DuckDB twins on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from foldwise.session import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["knn_cv_embeddings", "stratified_kfold", "hold_out3", "grouped_kfold", "batches", "confusion_multiclass",
        "confusion_labels", "fold_summary", "kendall_score", "spearman_score", "mutual_information", "prequential_knn",
        "add_noise", "exact_match", "nemenyi_groups", "cyclical", "one_hot", "missing_profile", "knn_classify",
        "bagging_knn", "covariance", "tied_ranks", "read_stream_files",
        "knn_join_pruned_part", "svm_cascade_rbf"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql_twin(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == exp


def test_every_query_has_a_callable(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert len(qs) >= 100 and set(sqls) <= set(qs)

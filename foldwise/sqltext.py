"""SQL building blocks for the DuckDB twins of our queries (the correctness
oracle).  They spell out in plain SQL the same rules the DataFrame code
implements, so each query can be checked against an independent engine.
"""

from __future__ import annotations

R = 6  # digits, as foldwise.functions.common.DIGITS


def r(expr: str, digits: int = R) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def fold_key(id_expr: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || CAST({id_expr} AS VARCHAR))"


def classes_values(classes: list) -> str:
    rows = ", ".join(f"('{c}', {i})" for i, c in enumerate(classes))
    return f"(VALUES {rows}) AS cl(class, class_idx)"


def metrics_ctes(counts: str, keys: list[str], classes: list | None, weighted: bool = True,
                 prefix: str = "m") -> tuple[str, str]:
    """CTEs turning ``counts(keys..., actual, predicted, n)`` into one
    metrics row per key: n, accuracy, error_rate, recall, specificity,
    precision, npv, f1.  Returns (cte_text, final_cte_name)."""
    k = ", ".join(keys) if keys else ""
    kc = (k + ", ") if keys else ""
    on = lambda a, b: " AND ".join([f"{a}.{x} = {b}.{x}" for x in keys] + [f"{a}.class = {b}.class"])
    if classes is None:
        cls = (f"{prefix}_cls AS (SELECT {kc}class, CAST(row_number() OVER ("
               f"{'PARTITION BY ' + k if keys else ''} ORDER BY class) - 1 AS INTEGER) AS class_idx FROM ("
               f"SELECT DISTINCT {kc}actual AS class FROM {counts} UNION "
               f"SELECT DISTINCT {kc}predicted AS class FROM {counts}) u)")
    else:
        grp = f"(SELECT DISTINCT {k} FROM {counts})" if keys else "(SELECT 1 AS one)"
        cls = (f"{prefix}_cls AS (SELECT {('g.' + ', g.'.join(keys) + ', ') if keys else ''}cl.class, cl.class_idx "
               f"FROM {grp} g CROSS JOIN {classes_values(classes)})")
    ctes = [
        cls,
        f"{prefix}_tp AS (SELECT {kc}actual AS class, sum(n) AS tp FROM {counts} WHERE actual = predicted GROUP BY ALL)",
        f"{prefix}_ra AS (SELECT {kc}actual AS class, sum(n) AS na FROM {counts} GROUP BY ALL)",
        f"{prefix}_rp AS (SELECT {kc}predicted AS class, sum(n) AS np FROM {counts} GROUP BY ALL)",
        f"{prefix}_tot AS (SELECT {kc}sum(n) AS total FROM {counts} {'GROUP BY ' + k if keys else ''})",
        f"{prefix}_cells AS (SELECT {', '.join('c.' + x for x in keys) + ', ' if keys else ''}c.class, c.class_idx, "
        f"coalesce(tp.tp, 0) AS tp, coalesce(ra.na, 0) AS na, coalesce(rp.np, 0) AS np, "
        f"coalesce(t.total, 0) AS total FROM {prefix}_cls c "
        f"LEFT JOIN {prefix}_tp tp ON {on('tp', 'c')} LEFT JOIN {prefix}_ra ra ON {on('ra', 'c')} "
        f"LEFT JOIN {prefix}_rp rp ON {on('rp', 'c')} "
        f"LEFT JOIN {prefix}_tot t ON {' AND '.join(f't.{x} = c.{x}' for x in keys) or 'TRUE'})",
        f"{prefix}_pc AS (SELECT {kc}class_idx, tp, na, total, na - tp AS fn, np - tp AS fp, "
        f"total - na - np + tp AS tn FROM {prefix}_cells)",
        f"{prefix}_pm AS (SELECT {kc}class_idx, tp, na, total, "
        f"CASE WHEN tp + fn = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall, "
        f"CASE WHEN tn + fp = 0 THEN 1.0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END AS specificity, "
        f"CASE WHEN tp + fp = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision, "
        f"CASE WHEN tn + fn = 0 THEN 1.0 ELSE CAST(tn AS DOUBLE) / (tn + fn) END AS npv FROM {prefix}_pc)",
        f"{prefix}_pf AS (SELECT *, CASE WHEN recall = 0 AND precision = 0 THEN 0.0 "
        f"ELSE 2 * recall * precision / (recall + precision) END AS f1 FROM {prefix}_pm)",
    ]
    comb = []
    for m in ["recall", "specificity", "precision", "npv", "f1"]:
        multi = (f"sum(CASE WHEN total = 0 THEN 0.0 ELSE CAST(na AS DOUBLE) / total END * {m})"
                 if weighted else f"avg({m})")
        comb.append(f"CASE WHEN count(*) <= 2 THEN arg_min({m}, class_idx) ELSE {multi} END AS {m}")
    ctes.append(
        f"{prefix}_out AS (SELECT {kc}CAST(max(total) AS BIGINT) AS n, "
        f"CASE WHEN max(total) = 0 THEN 0.0 ELSE CAST(sum(tp) AS DOUBLE) / max(total) END AS accuracy, "
        f"1 - CASE WHEN max(total) = 0 THEN 0.0 ELSE CAST(sum(tp) AS DOUBLE) / max(total) END AS error_rate, "
        f"{', '.join(comb)} FROM {prefix}_pf {'GROUP BY ' + k if keys else ''})")
    return ",\n".join(ctes), f"{prefix}_out"


METRICS = ["accuracy", "error_rate", "recall", "specificity", "precision", "npv", "f1"]


def summary_select(src: str, keys: list[str] = ()) -> str:
    parts = [*keys, "CAST(count(*) AS BIGINT) AS n_folds"]
    for m in METRICS:
        parts += [f"{r(f'avg({m})')} AS {m}_mean", f"{r(f'stddev_samp({m})')} AS {m}_std"]
    gb = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {', '.join(parts)} FROM {src}{gb}"


def knn_ctes(points: str, labels: str, k: int, pair_filter: str = "TRUE", prefix: str = "kn") -> tuple[str, str]:
    """CTEs for kNN votes.  ``points(row_id, pos, x)`` long features,
    ``labels(row_id, label, ...)``; ``pair_filter`` may use ``lq``/``ld``
    (label rows of the query and data side).  Output: (row_id, predicted)."""
    ctes = [
        f"{prefix}_d AS (SELECT q.row_id AS qid, t.row_id AS did, "
        f"round(sum((q.x - t.x) * (q.x - t.x)), 9) AS d2 FROM {points} q JOIN {points} t ON q.pos = t.pos "
        f"JOIN {labels} lq ON lq.row_id = q.row_id JOIN {labels} ld ON ld.row_id = t.row_id "
        f"WHERE {pair_filter} GROUP BY q.row_id, t.row_id)",
        f"{prefix}_r AS (SELECT qid, did, row_number() OVER (PARTITION BY qid ORDER BY d2, did) AS rk FROM {prefix}_d)",
        f"{prefix}_v AS (SELECT r.qid, l.label, count(*) AS votes, max(r.rk) AS last FROM {prefix}_r r "
        f"JOIN {labels} l ON l.row_id = r.did WHERE r.rk <= {k} GROUP BY r.qid, l.label)",
        f"{prefix}_p AS (SELECT qid AS row_id, label AS predicted FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY qid ORDER BY votes DESC, last ASC) AS r1 FROM {prefix}_v) WHERE r1 = 1)",
    ]
    return ",\n".join(ctes), f"{prefix}_p"

"""Parameters shared by the registered queries and their SQL twins.

The SQL text below is written for DuckDB (the oracle engine); the Spark side
of each query uses the library operators, never this text.
"""

from __future__ import annotations

import math

from lumisort.sources.samples import CLASS_NAMES, FAILED_EXTRACTION_MOD, FAILED_EXTRACTION_REM

# The parameters of the reference's grid, four classes and three cutoffs.
GRID_CLASSES = ["Ragdoll", "Siamese", "Persian", "Egyptian_Mau"]
GRID_CUTOFFS = [0.3, 0.6, 0.9]
OVO_PAIR = ("Persian", "Ragdoll")
SEED = 1
EMBEDDING_DIM = 64
PROJECTION_DIM = 8


def probe_weights(d: int = EMBEDDING_DIM) -> list[float]:
    """A fixed linear model used to check scoring/accuracy operators without a
    fit: w_j = round(sin(j + 1), 3)."""
    return [round(math.sin(j + 1), 3) for j in range(d)]


def sql_list(values) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]::DOUBLE[]"


def sql_str_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


NAMES_SQL = sql_str_list(CLASS_NAMES)

# samples (no split) as DuckDB SQL
NAMED_CTE = f"""named AS (
  SELECT {NAMES_SQL}[label + 1] || '_' || CAST(vec_id AS VARCHAR) || '.json' AS file_name,
         {NAMES_SQL}[label + 1] AS label_name,
         CASE WHEN vec_id % {FAILED_EXTRACTION_MOD} = {FAILED_EXTRACTION_REM} THEN NULL
              ELSE CAST(embedding AS DOUBLE[]) END AS features
  FROM embeddings)"""


def positional_cte(name: str, src: str, cutoff: float) -> str:
    """W1 in SQL: the first ceil(c*N) names of each class (double arithmetic)."""
    return f"""{name} AS (
  SELECT * EXCLUDE (_rk, _n), CASE WHEN _rk <= least(ceil({float(cutoff)!r}::DOUBLE * _n), _n) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, rank() OVER (PARTITION BY label_name ORDER BY file_name) AS _rk,
               count(*) OVER (PARTITION BY label_name) AS _n FROM {src}))"""


def rebalance_cte(name: str, src: str, cutoff: float, seed=SEED) -> str:
    """W2 in SQL: move the first |target - n_train| rows (md5 order) of the surplus split."""
    c = f"{float(cutoff)!r}::DOUBLE"
    return f"""{name} AS (
  SELECT * EXCLUDE (split, _n, _ntr, _rk, _tgt),
         CASE WHEN split = 'train' AND _rk <= greatest(_ntr - _tgt, 0) THEN 'test'
              WHEN split = 'test' AND _rk <= greatest(_tgt - _ntr, 0) THEN 'train'
              ELSE split END AS split
  FROM (SELECT *, floor({c} * _n) AS _tgt,
               rank() OVER (PARTITION BY label_name, split ORDER BY md5('{seed}:' || file_name), file_name) AS _rk
        FROM (SELECT *, count(*) OVER (PARTITION BY label_name) AS _n,
                     count(*) FILTER (WHERE split = 'train') OVER (PARTITION BY label_name) AS _ntr
              FROM {src})))"""


def samples_ctes(cutoff: float = 0.8) -> str:
    return "WITH " + NAMED_CTE + ",\n" + positional_cte("samples", "named", cutoff)


# ---------------------------------------------------------------- fits in SQL
# ``prob`` below is a CTE (pid, file_name, split, label 0/1, x DOUBLE[]): the rows
# of one or more binary problems.  The fits are recursive CTEs over whole batches.

def svm_cte(iterations: int, tolerance: float, reg: float = 0.1, step: float = 1.0, d: int = EMBEDDING_DIM) -> str:
    """``svm(pid, w)``: batch subgradient descent on hinge loss + L2, step / sqrt(t), as the
    reference's solver runs it; stops when a step is below ``tolerance`` (0: never)."""
    return f"""
trn AS (SELECT pid, 2 * label - 1 AS s, x, count(*) OVER (PARTITION BY pid) AS n FROM prob WHERE split = 'train'),
walk(pid, i, w, done) AS (
  SELECT DISTINCT pid, 0, list_transform(range({d}), lambda j: 0.0::DOUBLE), false FROM trn
  UNION ALL
  SELECT pid, i + 1, list(v ORDER BY j),
         i >= 1 AND sqrt(sum((v - u) * (v - u))) < {tolerance!r} * greatest(sqrt(sum(v * v)), 1.0)
  FROM (SELECT pid, i, j, any_value(w[j]) AS u,
               any_value(w[j]) * (1 - {step!r} / sqrt(i + 1) * {reg!r}) + {step!r} / sqrt(i + 1) * sum(c * x[j]) / any_value(n) AS v
        FROM (SELECT walk.pid, i, w, x, n, CASE WHEN 1 > s * list_dot_product(w, x) THEN s ELSE 0.0 END AS c
              FROM walk JOIN trn ON walk.pid = trn.pid WHERE NOT done AND i < {iterations}), range(1, {d + 1}) r(j)
        GROUP BY pid, i, j)
  GROUP BY pid, i),
svm AS (SELECT pid, arg_max(w, i) AS w FROM walk GROUP BY pid)"""


def logreg_cte(iterations: int = 800, reg: float = 0.01, d: int = EMBEDDING_DIM) -> str:
    """``logreg(pid, w, b)``: logistic loss + L2 on standardised features (intercept free),
    by accelerated gradient steps to the one minimum."""
    kappa = (0.25 * (d + 1) + reg) / reg
    beta = (kappa ** 0.5 - 1) / (kappa ** 0.5 + 1)
    size = 1 / (0.25 * (d + 1) + reg)
    return f"""
raw AS (SELECT pid, label, x, count(*) OVER (PARTITION BY pid) AS n FROM prob WHERE split = 'train'),
scale AS (SELECT pid, list(m ORDER BY j) AS m, list(s ORDER BY j) AS s FROM (
            SELECT pid, j, avg(x[j]) AS m, stddev_samp(x[j]) AS s FROM raw, range(1, {d + 1}) r(j) GROUP BY pid, j) GROUP BY pid),
trn AS (SELECT raw.pid, label, n, list_append(list_transform(range(1, {d + 1}), lambda j: (x[j] - m[j]) / s[j]), 1.0::DOUBLE) AS z
        FROM raw JOIN scale ON raw.pid = scale.pid),
walk(pid, i, w, y) AS (
  SELECT DISTINCT pid, 0, list_transform(range({d + 1}), lambda j: 0.0::DOUBLE), list_transform(range({d + 1}), lambda j: 0.0::DOUBLE) FROM trn
  UNION ALL
  SELECT pid, i + 1, list(v ORDER BY j), list(v + {beta!r} * (v - u) ORDER BY j)
  FROM (SELECT pid, i, j, any_value(w[j]) AS u,
               any_value(y[j]) - {size!r} * (sum(e * z[j]) / any_value(n) + CASE WHEN j <= {d} THEN {reg!r} * any_value(y[j]) ELSE 0 END) AS v
        FROM (SELECT walk.pid, i, w, y, z, n, 1 / (1 + exp(-list_dot_product(y, z))) - label AS e
              FROM walk JOIN trn ON walk.pid = trn.pid WHERE i < {iterations}), range(1, {d + 2}) r(j)
        GROUP BY pid, i, j)
  GROUP BY pid, i),
last AS (SELECT pid, arg_max(w, i) AS w FROM walk GROUP BY pid),
logreg AS (SELECT last.pid, list_transform(range(1, {d + 1}), lambda j: w[j] / s[j]) AS w,
                  w[{d + 1}] - list_sum(list_transform(range(1, {d + 1}), lambda j: w[j] * m[j] / s[j])) AS b
           FROM last JOIN scale ON last.pid = scale.pid)"""


def problem_cte(src: str, class1: str, class0: str | None) -> str:
    """``prob`` of one problem over ``src`` (file_name, label_name, split, features)."""
    rows = f"label_name IN ('{class1}', '{class0}') AND " if class0 else ""
    return f"""prob AS (SELECT 0 AS pid, file_name, split, CASE WHEN label_name = '{class1}' THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
                 features AS x FROM {src} WHERE {rows}features IS NOT NULL AND len(features) > 0)"""


def evaluation_sql(class1: str, class0: str | None, model: str, prediction: str) -> str:
    """The evaluation row; ``prediction`` is a boolean expression over prob p and the model m."""
    return f"""
SELECT '{class1}' AS class1, '{class0 or "all"}' AS class0, '{"ovo" if class0 else "ova"}' AS mode, '{model}' AS model,
       (SELECT count(*) FROM prob WHERE split = 'train') AS n_train, count(*) AS n_test,
       CAST(sum(CASE WHEN {prediction} AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
       CAST(sum(CASE WHEN NOT ({prediction}) AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
       round(100.0::DOUBLE * sum(CASE WHEN ({prediction}) = (label = 1) THEN 1 ELSE 0 END) / count(*), 6) AS accuracy,
       CAST(NULL AS VARCHAR) AS note
FROM prob p JOIN {model} m USING (pid) WHERE split = 'test'"""

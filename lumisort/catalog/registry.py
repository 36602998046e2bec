"""Registered queries: each reads the test tables, runs library operators on
Spark, and (where SQL can say the same thing) carries a DuckDB twin.

``QUERIES[name] = fn(spark, sf_dir) -> DataFrame``; ``ORACLE[name] = sql``.
Computed columns carry the same alias on both sides; doubles that come from
sums are rounded (engines add in different orders).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.catalog.fixtures import (
    GRID_CLASSES,
    GRID_CUTOFFS,
    NAMED_CTE,
    OVO_PAIR,
    SEED,
    evaluation_sql,
    logreg_cte,
    positional_cte,
    probe_weights,
    problem_cte,
    rebalance_cte,
    samples_ctes,
    sql_list,
    svm_cte,
)
from lumisort.functions import naming as N
from lumisort.functions import vectors as V
from lumisort.operators import aggregates as A
from lumisort.operators import joins as J
from lumisort.operators import problems as P
from lumisort.operators import split as S
from lumisort.operators.models import LinearModel, predict
from lumisort.sources.samples import CLASS_NAMES, embeddings_samples, table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _samples(spark, sf_dir, cutoff=0.8):
    return embeddings_samples(spark, sf_dir, cutoff=cutoff)


def _names(spark, sf_dir) -> DataFrame:
    """Names to exercise the naming rules: sample file names, their image
    form, and the last path part of every page URL."""
    s = embeddings_samples(spark, sf_dir, with_split=False)
    urls = table(spark, sf_dir, "pages").select(N.basename("url").alias("name"))
    return (s.select(F.col("file_name").alias("name"))
            .unionByName(s.select(F.regexp_replace("file_name", r"\.json$", ".jpg").alias("name")))
            .unionByName(urls))


NAMES_SQL_CTE = NAMED_CTE + """,
names AS (
  SELECT file_name AS name FROM named
  UNION ALL SELECT regexp_replace(file_name, '\\.json$', '.jpg') AS name FROM named
  UNION ALL SELECT string_split(url, '/')[-1] AS name FROM pages)"""

W = probe_weights()
W_SQL = sql_list(W)
PROBE_MODEL = LinearModel(W, 0.0, "svm")


# --------------------------------------------------------------------- naming

@register("label_from_name", f"""WITH {NAMES_SQL_CTE}
SELECT name, regexp_replace(regexp_extract(name, '^[^\\p{{Nd}}]*', 0), '_+$', '') AS label FROM names""")
def q_label_from_name(spark, sf_dir):
    return _names(spark, sf_dir).select("name", N.label_from_name("name").alias("label"))


@register("label_first_token", f"""WITH {NAMES_SQL_CTE}
SELECT name, split_part(name, '_', 1) AS token FROM names""")
def q_label_first_token(spark, sf_dir):
    return _names(spark, sf_dir).select("name", N.label_first_token("name").alias("token"))


@register("name_stem", f"""WITH {NAMES_SQL_CTE}
SELECT name, array_to_string(list_slice(string_split(name, '.'), 1, len(string_split(name, '.')) - 1), '') AS stem
FROM names""")
def q_name_stem(spark, sf_dir):
    return _names(spark, sf_dir).select("name", N.stem("name").alias("stem"))


@register("jpg_stem", f"""WITH {NAMES_SQL_CTE}
SELECT name, CASE WHEN suffix(name, 'jpg') THEN regexp_extract(name, '^(.*?).jpg', 1) || '.json' ELSE name END AS key
FROM names""")
def q_jpg_stem(spark, sf_dir):
    return _names(spark, sf_dir).select("name", N.jpg_stem("name").alias("key"))


@register("path_basename", """SELECT page_id, string_split(url, '/')[-1] AS name FROM pages""")
def q_path_basename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", N.basename("url").alias("name"))


@register("strip_root", """SELECT page_id,
  CASE WHEN strpos(url, '/') > 0 THEN substr(url, strpos(url, '/') + 1) ELSE '' END AS rest FROM pages""")
def q_strip_root(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", N.strip_root("url").alias("rest"))


def _object_keys(spark, sf_dir) -> DataFrame:
    """An object-store style listing derived from the data: one directory
    placeholder per split prefix, every feature key, every page URL."""
    s = _samples(spark, sf_dir)
    prefix = F.concat(F.lit("feature_extraction/"), F.col("split"), F.lit("1vsAll/"))
    dirs = s.select(prefix.alias("key")).distinct()
    keys = s.select(F.concat(prefix, F.col("file_name")).alias("key"))
    urls = table(spark, sf_dir, "pages").select(F.col("url").alias("key"))
    return dirs.unionByName(keys).unionByName(urls)


KEYS_SQL = samples_ctes(0.8) + """,
keys AS (
  SELECT DISTINCT 'feature_extraction/' || split || '1vsAll/' AS key FROM samples
  UNION ALL SELECT 'feature_extraction/' || split || '1vsAll/' || file_name AS key FROM samples
  UNION ALL SELECT url AS key FROM pages)"""


@register("suffix_filter", KEYS_SQL + "\nSELECT key FROM keys WHERE suffix(key, 'json')")
def q_suffix_filter(spark, sf_dir):
    k = _object_keys(spark, sf_dir)
    return k.where(N.has_suffix("key", "json"))


@register("drop_placeholder", KEYS_SQL + "\nSELECT key FROM keys WHERE string_split(key, '/')[-1] <> ''")
def q_drop_placeholder(spark, sf_dir):
    return P.drop_placeholders(_object_keys(spark, sf_dir), "key")


# --------------------------------------------------------------- problems

@register("class_pair_filter", samples_ctes() + f"""
SELECT file_name, label_name, split FROM samples WHERE label_name IN ('{OVO_PAIR[0]}', '{OVO_PAIR[1]}')""")
def q_class_pair_filter(spark, sf_dir):
    return P.class_pair_filter(_samples(spark, sf_dir), *OVO_PAIR).select("file_name", "label_name", "split")


@register("binary_label_exact", samples_ctes() + """
SELECT file_name, split, CASE WHEN label_name = 'Siamese' THEN 1.0 ELSE 0.0 END::DOUBLE AS label
FROM samples WHERE features IS NOT NULL AND len(features) > 0""")
def q_binary_label_exact(spark, sf_dir):
    d = P.select_problem(_samples(spark, sf_dir), "Siamese", mode="ova", match="exact")
    return d.select("file_name", "split", "label")


@register("binary_label_prefix", samples_ctes() + """
SELECT file_name, split, CASE WHEN starts_with(file_name, 'Siamese') THEN 1.0 ELSE 0.0 END::DOUBLE AS label
FROM samples WHERE features IS NOT NULL AND len(features) > 0""")
def q_binary_label_prefix(spark, sf_dir):
    d = P.select_problem(_samples(spark, sf_dir), "Siamese", mode="ova", match="prefix")
    return d.select("file_name", "split", "label")


@register("drop_null_features", samples_ctes() + """
SELECT file_name, label_name, split FROM samples WHERE features IS NOT NULL AND len(features) > 0""")
def q_drop_null_features(spark, sf_dir):
    return P.drop_null_features(_samples(spark, sf_dir)).select("file_name", "label_name", "split")


@register("union_pos_neg", samples_ctes() + f"""
SELECT file_name, split, 1.0::DOUBLE AS label FROM samples WHERE label_name = '{OVO_PAIR[0]}' AND features IS NOT NULL
UNION ALL
SELECT file_name, split, 0.0::DOUBLE AS label FROM samples WHERE label_name = '{OVO_PAIR[1]}' AND features IS NOT NULL""")
def q_union_pos_neg(spark, sf_dir):
    s = P.drop_null_features(_samples(spark, sf_dir))
    pos = s.where(F.col("label_name") == OVO_PAIR[0]).select("file_name", "split", F.lit(1.0).alias("label"))
    neg = s.where(F.col("label_name") == OVO_PAIR[1]).select("file_name", "split", F.lit(0.0).alias("label"))
    return pos.unionByName(neg)


@register("flatten_names", samples_ctes() + """
SELECT DISTINCT split, file_name FROM samples""")
def q_flatten_names(spark, sf_dir):
    """The flat one-vs-all listing: one row per (split, name), class level dropped."""
    from lumisort.sinks.writers import dedupe_names
    return dedupe_names(_samples(spark, sf_dir)).select("split", "file_name")


# --------------------------------------------------------------- vectors

@register("vector_text_parse", samples_ctes() + """,
t AS (SELECT file_name, COALESCE(CAST(features AS VARCHAR), 'null') AS txt FROM samples),
p AS (SELECT file_name, list_transform(string_split(trim(regexp_replace(trim(txt), '^\\[|\\]$', '', 'g')), ','),
                                       lambda x: TRY_CAST(trim(x) AS DOUBLE)) AS a FROM t),
v AS (SELECT file_name, CASE WHEN list_count(a) = len(a) THEN a END AS vec FROM p)
SELECT file_name, vec IS NULL AS is_null, CAST(len(vec) AS BIGINT) AS n, round(list_sum(vec), 6) AS total FROM v""")
def q_vector_text_parse(spark, sf_dir):
    s = _samples(spark, sf_dir).select("file_name", V.vector_to_text("features").alias("txt"))
    vec = V.parse_vector_text("txt")
    return s.select("file_name", vec.alias("vec")).select(
        "file_name", F.col("vec").isNull().alias("is_null"), F.size("vec").cast("long").alias("n"),
        F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register("vector_json_roundtrip", samples_ctes() + """
SELECT file_name, features IS NULL AS is_null, CAST(len(features) AS BIGINT) AS n,
       round(list_sum(features), 6) AS total FROM samples""")
def q_vector_json_roundtrip(spark, sf_dir):
    s = _samples(spark, sf_dir).select("file_name", V.vector_to_text("features").alias("txt"))
    vec = V.text_to_vector("txt")
    return s.select("file_name", vec.alias("vec")).select(
        "file_name", F.col("vec").isNull().alias("is_null"), F.size("vec").cast("long").alias("n"),
        F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register("linear_score", samples_ctes() + f"""
SELECT s.file_name, d.margin FROM samples s LEFT JOIN (
  SELECT file_name, round(list_dot_product(features, {W_SQL}), 6) AS margin FROM samples WHERE features IS NOT NULL
) d USING (file_name)""")
def q_linear_score(spark, sf_dir):
    s = embeddings_samples(spark, sf_dir, with_split=False)
    return s.select("file_name", F.round(V.linear_margin(F.col("features"), W), 6).alias("margin"))


# ------------------------------------------------------------ aggregates

@register("distinct_labels", samples_ctes() + """
SELECT label_name, count(*) AS n_files, min(file_name) AS first_file FROM samples GROUP BY label_name""")
def q_distinct_labels(spark, sf_dir):
    return A.distinct_labels(embeddings_samples(spark, sf_dir, with_split=False))


@register("names_by_label", samples_ctes() + """
SELECT label_name, file_name, CAST(row_number() OVER (PARTITION BY label_name ORDER BY file_name) AS INTEGER) AS position
FROM samples""")
def q_names_by_label(spark, sf_dir):
    return A.names_by_label(embeddings_samples(spark, sf_dir, with_split=False))


@register("split_counts", samples_ctes() + """
SELECT label_name, count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test
FROM samples GROUP BY label_name""")
def q_split_counts(spark, sf_dir):
    return A.split_counts(_samples(spark, sf_dir))


@register("set_sizes", samples_ctes() + """
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test,
       count(*) AS n_total, round(100.0::DOUBLE * count(*) FILTER (WHERE split = 'train') / count(*), 6) AS train_pct
FROM samples""")
def q_set_sizes(spark, sf_dir):
    d = A.set_sizes(_samples(spark, sf_dir))
    return d.withColumn("train_pct", F.round("train_pct", 6))


# ---------------------------------------------------------- split / sample

@register("split_positional", "WITH " + NAMED_CTE + ",\n" + positional_cte("w", "named", 0.6) + """
SELECT file_name, label_name, split FROM w""")
def q_split_positional(spark, sf_dir):
    s = embeddings_samples(spark, sf_dir, with_split=False)
    return S.split_positional(s, 0.6).select("file_name", "label_name", "split")


@register("rebalance", samples_ctes() + ",\n" + rebalance_cte("r", "samples", 0.3) + """
SELECT file_name, label_name, split FROM r""")
def q_rebalance(spark, sf_dir):
    return S.rebalance(_samples(spark, sf_dir), 0.3, SEED).select("file_name", "label_name", "split")


_CHAIN_SQL = (samples_ctes() + ",\n" + rebalance_cte("r1", "samples", 0.3) + ",\n"
              + rebalance_cte("r2", "r1", 0.6) + ",\n" + rebalance_cte("r3", "r2", 0.9))


@register("rebalance_chain", _CHAIN_SQL + "\nSELECT file_name, label_name, split FROM r3")
def q_rebalance_chain(spark, sf_dir):
    from lumisort.plans.grid import chained_splits
    chain = chained_splits(_samples(spark, sf_dir).select("label_name", "file_name", "split"), GRID_CUTOFFS, SEED)
    return chain.select("file_name", "label_name", "split")


@register("sample_k_per_class", samples_ctes() + """
SELECT file_name, label_name FROM (
  SELECT *, rank() OVER (PARTITION BY label_name ORDER BY md5('1:' || file_name), file_name) AS rk FROM samples)
WHERE rk <= 7""")
def q_sample_k_per_class(spark, sf_dir):
    return S.sample_per_class(_samples(spark, sf_dir), 7, SEED).select("file_name", "label_name")


@register("systematic_sample", samples_ctes() + """
SELECT file_name, label_name, split FROM (
  SELECT *, row_number() OVER (PARTITION BY label_name, split ORDER BY file_name) AS pos FROM samples)
WHERE (pos - 1) % 2 = 0""")
def q_systematic_sample(spark, sf_dir):
    return S.systematic_sample(_samples(spark, sf_dir), 2).select("file_name", "label_name", "split")


# ----------------------------------------------------------------- joins

_TRAIN_WINS_SQL = "WITH " + NAMED_CTE + ",\n" + positional_cte("a", "named", 0.8) + ",\n" + \
    positional_cte("b", "named", 0.5) + """,
tr AS (SELECT file_name, label_name, features FROM a WHERE split = 'train'),
te AS (SELECT file_name, label_name, features FROM b WHERE split = 'test')
SELECT file_name, label_name, 'train' AS split, features IS NOT NULL AS has_features FROM tr
UNION ALL
SELECT file_name, label_name, 'test' AS split, features IS NOT NULL AS has_features FROM te
WHERE file_name NOT IN (SELECT file_name FROM tr)"""


@register("train_wins", _TRAIN_WINS_SQL)
def q_train_wins(spark, sf_dir):
    """Train copies from the 0.8 split, test copies from the 0.5 split: the
    names ranked between the two cutoffs exist in both splits."""
    s = embeddings_samples(spark, sf_dir, with_split=False)
    tr = S.split_positional(s, 0.8).where(F.col("split") == "train").drop("split")
    te = S.split_positional(s, 0.5).where(F.col("split") == "test").drop("split")
    r = J.resolve_split(tr, te)
    return r.select("file_name", "label_name", "split", F.col("features").isNotNull().alias("has_features"))


@register("skip_existing", "WITH " + NAMED_CTE + ",\n" + positional_cte("b", "named", 0.5) + """,
images AS (SELECT regexp_replace(file_name, '\\.json$', '.jpg') AS image_name FROM named),
existing AS (SELECT file_name FROM b WHERE split = 'train')
SELECT image_name FROM images
WHERE regexp_extract(image_name, '^(.*?).jpg', 1) || '.json' NOT IN (SELECT file_name FROM existing)""")
def q_skip_existing(spark, sf_dir):
    s = embeddings_samples(spark, sf_dir, with_split=False)
    images = s.select(F.regexp_replace("file_name", r"\.json$", ".jpg").alias("image_name"))
    images = images.withColumn("file_name", N.jpg_stem("image_name"))
    existing = S.split_positional(s, 0.5).where(F.col("split") == "train").select("file_name")
    return J.skip_existing(images, existing).select("image_name")


@register("attach_features", samples_ctes() + ",\n" + rebalance_cte("r", "samples", 0.3) + """
SELECT r.file_name, r.split, CAST(len(s.features) AS BIGINT) AS n_dims, round(list_sum(s.features), 6) AS total
FROM (SELECT file_name, split FROM r) r JOIN (SELECT file_name, features FROM named) s USING (file_name)""")
def q_attach_features(spark, sf_dir):
    assignment = S.rebalance(_samples(spark, sf_dir), 0.3, SEED).select("file_name", "split")
    feats = embeddings_samples(spark, sf_dir, with_split=False)
    j = J.attach_features(assignment, feats)
    return j.select("file_name", "split", F.size("features").cast("long").alias("n_dims"),
                    F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def _pairs_sql() -> str:
    from itertools import combinations
    rows = [f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(combinations(GRID_CLASSES, 2))]
    return "pairs(pair_idx, class1, class0) AS (VALUES " + ", ".join(rows) + ")"


def _grid_sql() -> str:
    cut_rows = ", ".join(f"({i}, {c!r}::DOUBLE)" for i, c in enumerate(GRID_CUTOFFS))
    return "cuts(cutoff_idx, cutoff) AS (VALUES " + cut_rows + ")"


@register("grid_points", "WITH " + _pairs_sql() + ", " + _grid_sql() + """
SELECT pair_idx, class1, class0, cutoff_idx, cutoff,
       CAST(cutoff AS VARCHAR) || '/' || CAST(round(1 - cutoff, 2) AS VARCHAR) AS train_test
FROM pairs, cuts""")
def q_grid_points(spark, sf_dir):
    # the pairs come from the grid's class list, validated against the data's classes
    present = embeddings_samples(spark, sf_dir, with_split=False).select("label_name").distinct()
    pairs = J.class_pairs(spark, GRID_CLASSES)
    pairs = pairs.join(present.withColumnRenamed("label_name", "class1"), "class1", "left_semi")
    pairs = pairs.join(present.withColumnRenamed("label_name", "class0"), "class0", "left_semi")
    g = J.grid_points(pairs, GRID_CUTOFFS)
    return g.select(F.col("pair_idx").cast("int"), "class1", "class0", F.col("cutoff_idx").cast("int"),
                    "cutoff", "train_test")


@register("pair_counts", samples_ctes() + ", " + _pairs_sql() + """,
c AS (SELECT label_name, count(*) FILTER (WHERE split = 'train') AS n_train,
             count(*) FILTER (WHERE split = 'test') AS n_test FROM samples GROUP BY label_name)
SELECT p.pair_idx, p.class1, p.class0, c1.n_train AS class1_n_train, c1.n_test AS class1_n_test,
       c0.n_train AS class0_n_train, c0.n_test AS class0_n_test
FROM pairs p LEFT JOIN c c1 ON c1.label_name = p.class1 LEFT JOIN c c0 ON c0.label_name = p.class0""")
def q_pair_counts(spark, sf_dir):
    counts = A.split_counts(_samples(spark, sf_dir))
    pairs = J.class_pairs(spark, GRID_CLASSES)
    return J.pair_counts(pairs, counts, len(GRID_CLASSES)).select(
        F.col("pair_idx").cast("int"), "class1", "class0", "class1_n_train", "class1_n_test",
        "class0_n_train", "class0_n_test")


# ------------------------------------------------- scoring with a fixed model

def _probe_predictions(df: DataFrame, class1: str, class0: str | None, mode: str) -> DataFrame:
    prob = P.select_problem(df, class1, class0, mode)
    return predict(PROBE_MODEL, prob)


_PRED_SQL = f"""
pred AS (SELECT *, CASE WHEN list_dot_product(features, {W_SQL}) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
                CASE WHEN label_name = 'Persian' THEN 1.0 ELSE 0.0 END::DOUBLE AS label
         FROM samples WHERE features IS NOT NULL AND len(features) > 0)"""


@register("accuracy_fixed", samples_ctes() + "," + _PRED_SQL + """
SELECT split, count(*) AS n_test, CAST(sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(100.0::DOUBLE * sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) / count(*), 6) AS accuracy
FROM pred GROUP BY split""")
def q_accuracy_fixed(spark, sf_dir):
    p = _probe_predictions(_samples(spark, sf_dir), "Persian", None, "ova")
    a = A.accuracy(p, ["split"])
    return a.select("split", "n_test", F.col("n_correct").cast("long"), F.round("accuracy", 6).alias("accuracy"))


@register("tp_tn_fixed", samples_ctes() + "," + _PRED_SQL + """
SELECT split, sum(label * prediction) AS tp, sum((1 - label) * (1 - prediction)) AS tn, count(*) AS n
FROM pred GROUP BY split""")
def q_tp_tn_fixed(spark, sf_dir):
    p = _probe_predictions(_samples(spark, sf_dir), "Persian", None, "ova")
    return A.tp_tn(p, ["split"])


@register("prediction_class", samples_ctes() + f"""
SELECT file_name, CASE WHEN list_dot_product(features, {W_SQL}) > 0 THEN '{OVO_PAIR[0]}' ELSE '{OVO_PAIR[1]}' END
       AS predicted_class
FROM samples WHERE label_name IN ('{OVO_PAIR[0]}', '{OVO_PAIR[1]}') AND split = 'test'
  AND features IS NOT NULL AND len(features) > 0""")
def q_prediction_class(spark, sf_dir):
    p = _probe_predictions(_samples(spark, sf_dir), OVO_PAIR[0], OVO_PAIR[1], "ovo").where(F.col("split") == "test")
    return p.select("file_name", N.prediction_to_class("prediction", OVO_PAIR[1], OVO_PAIR[0]).alias("predicted_class"))


def _pivot_sql() -> str:
    labels = [f"{c}/{round(1 - c, 2)}" for c in GRID_CUTOFFS]
    steps = []
    src = "samples"
    for i, c in enumerate(GRID_CUTOFFS):
        steps.append(rebalance_cte(f"r{i}", src, c))
        src = f"r{i}"
    per_cut = " UNION ALL ".join(
        f"SELECT '{lab}' AS train_test, file_name, label_name, split, features FROM r{i}"
        for i, lab in enumerate(labels))
    cols = ", ".join(f"max(CASE WHEN train_test = '{lab}' THEN accuracy END) AS \"{lab}\"" for lab in labels)
    return (samples_ctes() + ",\n" + ",\n".join(steps) + ",\n" + _pairs_sql() + f""",
states AS ({per_cut}),
prob AS (SELECT s.train_test, p.class1, p.class0, s.split,
                CASE WHEN s.label_name = p.class1 THEN 1.0 ELSE 0.0 END AS label,
                CASE WHEN list_dot_product(s.features, {W_SQL}) > 0 THEN 1.0 ELSE 0.0 END AS prediction
         FROM states s JOIN pairs p ON s.label_name IN (p.class1, p.class0)
         WHERE s.features IS NOT NULL AND len(s.features) > 0),
acc AS (SELECT class1, class0, train_test,
               100.0::DOUBLE * sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) / count(*) AS accuracy
        FROM prob WHERE split = 'test' GROUP BY class1, class0, train_test)
SELECT class1, class0, {cols.replace('max(CASE', 'round(max(CASE').replace(' END) AS', ' END), 6) AS')}
FROM acc GROUP BY class1, class0""")


@register("accuracy_pivot", _pivot_sql())
def q_accuracy_pivot(spark, sf_dir):
    """The grid table with a fixed model: rebalance chain x class pairs,
    accuracy on each test split, pivoted by ratio label."""
    from lumisort.plans.grid import score_grid
    res = score_grid(_samples(spark, sf_dir), PROBE_MODEL, GRID_CLASSES, GRID_CUTOFFS, seed=SEED)
    piv = A.accuracy_pivot(res, GRID_CUTOFFS)
    return piv.select("class1", "class0", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in piv.columns[2:]])


# ---------------------------------------------------------- fitted models
# The SQL twins fit the same problems on their own: the reference's solver step by
# step for MLlib's, the same descent run on for the solvers that go to the minimum.

def _eval_row(df, class1, class0, mode, model="svm", solver="bundle"):
    from lumisort.plans.evaluate import evaluate
    row, _ = evaluate(df, class1, class0, mode, model, solver=solver)
    return row.withColumn("accuracy", F.round("accuracy", 6))


_SVM_TO_MINIMUM = svm_cte(600, 0.0)
_SVM_HIT = "list_dot_product(m.w, p.x) > 0"
_POSITIONAL_06 = "WITH RECURSIVE " + NAMED_CTE + ",\n" + positional_cte("s6", "named", 0.6) + ",\n"
_REBALANCED_06 = (samples_ctes().replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + rebalance_cte("r6", "samples", 0.6) + ",\n")


def _positional_06(spark, sf_dir):
    return S.split_positional(embeddings_samples(spark, sf_dir, with_split=False), 0.6)


@register("svm_ovo", _POSITIONAL_06 + problem_cte("s6", *OVO_PAIR) + "," + _SVM_TO_MINIMUM
          + evaluation_sql(*OVO_PAIR, "svm", _SVM_HIT))
def q_svm_ovo(spark, sf_dir):
    """Positional split 0.6, linear SVM Persian vs Ragdoll, test accuracy."""
    return _eval_row(_positional_06(spark, sf_dir), OVO_PAIR[0], OVO_PAIR[1], "ovo")


@register("svm_sgd_ovo", _POSITIONAL_06 + problem_cte("s6", *OVO_PAIR) + "," + svm_cte(100, 0.001)
          + evaluation_sql(*OVO_PAIR, "svm", _SVM_HIT))
def q_svm_sgd_ovo(spark, sf_dir):
    """The same problem with the reference's solver (full-batch descent)."""
    return _eval_row(_positional_06(spark, sf_dir), OVO_PAIR[0], OVO_PAIR[1], "ovo", solver="sgd")


@register("svm_ova", _REBALANCED_06 + problem_cte("r6", "Persian", None) + "," + _SVM_TO_MINIMUM
          + evaluation_sql("Persian", None, "svm", _SVM_HIT))
def q_svm_ova(spark, sf_dir):
    """One-vs-all (Persian vs every other class) after a 0.6 rebalance."""
    s = S.rebalance(_samples(spark, sf_dir), 0.6, SEED)
    return _eval_row(s, "Persian", None, "ova")


@register("logreg_ovo", _REBALANCED_06 + problem_cte("r6", *OVO_PAIR) + "," + logreg_cte()
          + evaluation_sql(*OVO_PAIR, "logreg", "list_dot_product(m.w, p.x) + m.b > 0"))
def q_logreg_ovo(spark, sf_dir):
    """Logistic regression, one-vs-one, after a 0.6 rebalance."""
    s = S.rebalance(_samples(spark, sf_dir), 0.6, SEED)
    return _eval_row(s, OVO_PAIR[0], OVO_PAIR[1], "ovo", model="logreg")


@register("logreg_predictions", _REBALANCED_06 + problem_cte("r6", *OVO_PAIR) + "," + logreg_cte() + """
SELECT file_name, label, round(1 / (1 + exp(-(list_dot_product(m.w, p.x) + m.b))), 3) AS probability,
       CASE WHEN list_dot_product(m.w, p.x) + m.b > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM prob p JOIN logreg m USING (pid) WHERE split = 'test'""")
def q_logreg_predictions(spark, sf_dir):
    """Logistic regression test predictions: label, probability of class 1,
    prediction (the reference's ``select('label','probability','prediction')``)."""
    from lumisort.plans.evaluate import fit
    prob = P.select_problem(S.rebalance(_samples(spark, sf_dir), 0.6, SEED), OVO_PAIR[0], OVO_PAIR[1], "ovo")
    m = fit(prob.where(F.col("split") == "train"), "logreg")
    test = predict(m, prob.where(F.col("split") == "test"))
    return test.select("file_name", "label", F.round("probability", 3).alias("probability"), "prediction")


def _grid_fit_sql() -> str:
    labels = [f"{c}/{round(1 - c, 2)}" for c in GRID_CUTOFFS]
    steps, src = [], "samples"
    for i, c in enumerate(GRID_CUTOFFS):
        steps.append(rebalance_cte(f"r{i}", src, c))
        src = f"r{i}"
    states = " UNION ALL ".join(f"SELECT {i} AS cut, file_name, label_name, split, features FROM r{i}"
                                for i in range(len(GRID_CUTOFFS)))
    cols = ", ".join(f"round(max(CASE WHEN cut = {i} THEN accuracy END), 6) AS \"{lab}\"" for i, lab in enumerate(labels))
    return (samples_ctes().replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + ",\n".join(steps) + ",\n" + _pairs_sql() + f""",
states AS ({states}),
prob AS (SELECT s.cut * 100 + p.pair_idx AS pid, s.cut, p.class1, p.class0, file_name, split, features AS x,
                CASE WHEN label_name = p.class1 THEN 1.0 ELSE 0.0 END::DOUBLE AS label
         FROM states s JOIN pairs p ON s.label_name IN (p.class1, p.class0) WHERE features IS NOT NULL AND len(features) > 0),
""" + svm_cte(400, 0.0) + f""",
acc AS (SELECT class1, class0, cut, 100.0::DOUBLE * sum(CASE WHEN ({_SVM_HIT}) = (label = 1) THEN 1 ELSE 0 END) / count(*) AS accuracy
        FROM prob p JOIN svm m USING (pid) WHERE split = 'test' GROUP BY class1, class0, cut)
SELECT class1, class0, {cols} FROM acc GROUP BY class1, class0""")


@register("svm_grid", _grid_fit_sql())
def q_svm_grid(spark, sf_dir):
    """The reference's grid: 3 chained cutoffs x 6 pairs = 18 fits, pivoted."""
    from lumisort.plans.grid import grid_table, run_grid
    res = run_grid(_samples(spark, sf_dir), GRID_CLASSES, GRID_CUTOFFS, mode="ovo", parallelism=9, seed=SEED)
    piv = grid_table(res, GRID_CUTOFFS)
    return piv.select("class1", "class0", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in piv.columns[2:]])


_OVERLAP_SQL = "WITH RECURSIVE " + NAMED_CTE + ",\n" + positional_cte("a", "named", 0.8) + ",\n" + \
    positional_cte("b", "named", 0.5) + """,
mixed AS (SELECT * FROM a WHERE split = 'train' UNION ALL
         SELECT * FROM b WHERE split = 'test' AND file_name NOT IN (SELECT file_name FROM a WHERE split = 'train')),
"""


@register("evaluate_overlap", _OVERLAP_SQL + problem_cte("mixed", *OVO_PAIR) + "," + _SVM_TO_MINIMUM
          + evaluation_sql(*OVO_PAIR, "svm", _SVM_HIT))
def q_evaluate_overlap(spark, sf_dir):
    """Evaluation of a table that holds names in both splits: they are trained on only."""
    s = embeddings_samples(spark, sf_dir, with_split=False)
    both = (S.split_positional(s, 0.8).where(F.col("split") == "train")
            .unionByName(S.split_positional(s, 0.5).where(F.col("split") == "test")))
    return _eval_row(both, OVO_PAIR[0], OVO_PAIR[1], "ovo")


_READABLE = "substr(file_name, -6, 1) <> '3'"


@register("evaluate_unreadable", "WITH RECURSIVE " + NAMED_CTE + ",\n" + positional_cte("a", "named", 0.8) + ",\n"
          + positional_cte("b", "named", 0.5) + f""",
read_ AS (SELECT * FROM a WHERE split = 'train' AND {_READABLE}),
mixed AS (SELECT * FROM read_ UNION ALL SELECT * FROM b WHERE split = 'test' AND file_name NOT IN (SELECT file_name FROM read_)),
""" + problem_cte("mixed", *OVO_PAIR) + "," + _SVM_TO_MINIMUM + evaluation_sql(*OVO_PAIR, "svm", _SVM_HIT))
def q_evaluate_unreadable(spark, sf_dir):
    """Names in both splits, some with a train copy that can't be read: those are test rows."""
    from lumisort.plans.evaluate import evaluate
    s = embeddings_samples(spark, sf_dir, with_split=False)
    readable = (F.substring("file_name", -6, 1) != "3") | (F.col("split") == "test")
    both = (S.split_positional(s, 0.8).where(F.col("split") == "train")
            .unionByName(S.split_positional(s, 0.5).where(F.col("split") == "test"))).withColumn("readable", readable)
    row, _ = evaluate(both, OVO_PAIR[0], OVO_PAIR[1], "ovo", valid_col="readable")
    return row.withColumn("accuracy", F.round("accuracy", 6))


@register("model_roundtrip", _POSITIONAL_06 + problem_cte("s6", *OVO_PAIR) + "," + _SVM_TO_MINIMUM + f"""
SELECT file_name, label, CASE WHEN {_SVM_HIT} THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
       CASE WHEN {_SVM_HIT} THEN '{OVO_PAIR[0]}' ELSE '{OVO_PAIR[1]}' END AS predicted_class
FROM prob p JOIN svm m USING (pid) WHERE split = 'test'""")
def q_model_roundtrip(spark, sf_dir):
    """Test predictions of a fitted model that was saved and loaded again, once as a model and once as a bundle
    that names its classes."""
    from lumisort.operators.models import ModelBundle, load_model, save_model
    from lumisort.plans.evaluate import fit
    from lumisort.session import remove_scratch, scratch_path
    prob = P.select_problem(_positional_06(spark, sf_dir), OVO_PAIR[0], OVO_PAIR[1], "ovo")
    path, named = scratch_path(spark, "model"), scratch_path(spark, "bundle")
    model = fit(prob.where(F.col("split") == "train"))
    save_model(model, path)
    ModelBundle.of(model, (OVO_PAIR[1], OVO_PAIR[0])).save(spark, named)
    model, bundle = load_model(path), ModelBundle.load(spark, named)
    remove_scratch(spark, path)
    remove_scratch(spark, named)
    test = bundle.predict(prob.where(F.col("split") == "test"))
    return predict(model, test).select("file_name", "label", "prediction", "predicted_class")


def _ovr_sql() -> str:
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(sorted(CLASS_NAMES)))
    return (_REBALANCED_06 + f"""classes(pid, class1) AS (VALUES {names}),
prob AS (SELECT c.pid, file_name, split, CASE WHEN label_name = class1 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, features AS x
         FROM r6, classes c WHERE features IS NOT NULL AND len(features) > 0),
""" + svm_cte(600, 0.0) + """,
best AS (SELECT p.file_name, arg_max(c.class1, list_dot_product(m.w, p.x)) AS prediction
         FROM prob p JOIN svm m USING (pid) JOIN classes c USING (pid) WHERE split = 'test' GROUP BY p.file_name)
SELECT r6.file_name, label_name, prediction FROM r6 LEFT JOIN best USING (file_name) WHERE split = 'test'""")


@register("ovr_predictions", _ovr_sql())
def q_ovr_predictions(spark, sf_dir):
    """All classes at once: one-vs-rest SVMs after a 0.6 rebalance, saved and loaded as a bundle; the class with the
    largest margin for every test row."""
    from lumisort.operators.many import train_one_vs_rest
    from lumisort.operators.models import ModelBundle
    from lumisort.session import remove_scratch, scratch_path
    s = S.rebalance(_samples(spark, sf_dir), 0.6, SEED)
    path = scratch_path(spark, "ovr")
    ModelBundle.of(train_one_vs_rest(s.where(F.col("split") == "train"))).save(spark, path)
    bundle = ModelBundle.load(spark, path)
    remove_scratch(spark, path)
    return bundle.predict(s.where(F.col("split") == "test")).select(
        "file_name", "label_name", F.col("predicted_class").alias("prediction"))


@register("run_summary", _POSITIONAL_06 + problem_cte("s6", *OVO_PAIR) + "," + _SVM_TO_MINIMUM + f""",
row AS ({evaluation_sql(*OVO_PAIR, "svm", _SVM_HIT)})
SELECT class1, class0, 0.6::DOUBLE AS cutoff, round(100.0::DOUBLE * n_train / (n_train + n_test), 6) AS train_pct,
       printf('%.2f', accuracy) AS accuracy_text, accuracy FROM row""")
def q_run_summary(spark, sf_dir):
    """The summary of one run, written as JSON and read back (K6, P16, P17)."""
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sinks.writers import write_run_summary
    path = scratch_path(spark, "run-summary")
    write_run_summary(_eval_row(_positional_06(spark, sf_dir), OVO_PAIR[0], OVO_PAIR[1], "ovo"), path, 0.6)
    back = durable(spark.read.schema("class1 string, class0 string, cutoff double, train_pct double, "
                                     "accuracy_text string, accuracy double").json(path))
    remove_scratch(spark, path)
    return back.withColumn("train_pct", F.round("train_pct", 6))


@register("predictions_roundtrip", samples_ctes() + "," + _PRED_SQL + """
SELECT file_name, label, prediction FROM pred WHERE split = 'test'""")
def q_predictions_roundtrip(spark, sf_dir):
    """Predictions written as JSON lines and read back (K5)."""
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sinks.writers import write_predictions
    path = scratch_path(spark, "predictions")
    write_predictions(_probe_predictions(_samples(spark, sf_dir), "Persian", None, "ova").where(F.col("split") == "test"), path)
    back = durable(spark.read.schema("file_name string, label double, prediction double").json(path))
    remove_scratch(spark, path)
    return back


@register("vector_forms", "WITH " + NAMED_CTE + """
SELECT file_name, CAST(len(features) AS BIGINT) AS n, round(list_sum(features), 6) AS total FROM named WHERE features IS NOT NULL""")
def q_vector_forms(spark, sf_dir):
    """Arrays to ML vectors and back (P12, P18)."""
    s = embeddings_samples(spark, sf_dir, with_split=False).where(F.col("features").isNotNull())
    s = s.select("file_name", V.from_ml_vector(V.to_ml_vector("features")).alias("v"))
    return s.select("file_name", F.size("v").cast("long").alias("n"),
                    F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register("logreg_roundtrip", _REBALANCED_06 + problem_cte("r6", *OVO_PAIR) + "," + logreg_cte() + """
SELECT file_name, label, CASE WHEN list_dot_product(m.w, p.x) + m.b > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM prob p JOIN logreg m USING (pid) WHERE split = 'test'""")
def q_logreg_roundtrip(spark, sf_dir):
    """Test predictions of a logistic regression that was saved and loaded again (K9)."""
    from lumisort.operators.models import load_model, save_model
    from lumisort.plans.evaluate import fit
    from lumisort.session import remove_scratch, scratch_path
    prob = P.select_problem(S.rebalance(_samples(spark, sf_dir), 0.6, SEED), OVO_PAIR[0], OVO_PAIR[1], "ovo")
    path = scratch_path(spark, "logreg")
    save_model(fit(prob.where(F.col("split") == "train"), "logreg"), path)
    model = load_model(path, "logreg")
    remove_scratch(spark, path)
    return predict(model, prob.where(F.col("split") == "test")).select("file_name", "label", "prediction")


@register("split_default", "WITH " + NAMED_CTE + ",\n" + positional_cte("w", "named", 0.8) + """
SELECT label_name, count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test
FROM w GROUP BY label_name""")
def q_split_default(spark, sf_dir):
    """The positional split without a cutoff takes 0.8 (P16)."""
    return A.split_counts(S.split_positional(embeddings_samples(spark, sf_dir, with_split=False), None))


@register("flatten_roundtrip", samples_ctes() + """,
dup AS (SELECT * FROM samples UNION ALL SELECT * REPLACE ('zz_copy' AS label_name) FROM samples WHERE label_name = 'Siamese')
SELECT split, file_name, min(label_name) AS label_name, any_value(round(list_sum(features), 6)) AS total FROM dup GROUP BY split, file_name""")
def q_flatten_roundtrip(spark, sf_dir):
    """The flat one-vs-all layout written and read back (K2, U2): a name in two classes of a split is there once."""
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sinks.writers import flatten_for_ova
    s = _samples(spark, sf_dir)
    both = s.unionByName(s.where(F.col("label_name") == "Siamese").withColumn("label_name", F.lit("zz_copy")))
    path = scratch_path(spark, "flat")
    out = durable(flatten_for_ova(both, path).select(
        "split", "file_name", "label_name", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total")))
    remove_scratch(spark, path)
    return out


# ---------------------------------------------------- featurise and stream

def _projection_sql() -> str:
    from lumisort.catalog.fixtures import EMBEDDING_DIM, PROJECTION_DIM
    return f"""WITH x AS (
  SELECT vec_id, UNNEST(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
d AS (SELECT range AS j FROM range({PROJECTION_DIM}))
SELECT x.vec_id, CAST(d.j AS BIGINT) AS dim, round(sum(x.v * (((7 * x.i + 13 * d.j) % 17) - 8) / 8.0), 5) AS value
FROM x, d GROUP BY x.vec_id, d.j"""


@register("featurize_projection", _projection_sql())
def q_featurize_projection(spark, sf_dir):
    """Batch inference over every embedding with the default fixed-projection
    model (64 -> 8), long form (vec_id, dim, value)."""
    from lumisort.catalog.fixtures import EMBEDDING_DIM, PROJECTION_DIM
    from lumisort.operators.featurize import featurize, projection_model
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    f = featurize(emb, projection_model(EMBEDDING_DIM, PROJECTION_DIM), "embedding", batch_size=256)
    return f.select("vec_id", F.posexplode("features").alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("long"), F.round("value", 5).alias("value"))


@register("featurize_failures", """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 10 = 5 THEN NULL WHEN vec_id % 10 = 3 THEN list_slice(e, 1, 63) ELSE e END AS x
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
f AS (SELECT vec_id, x IS NULL OR len(x) <> 64 AS failed, x FROM v)
SELECT vec_id, failed, CASE WHEN NOT failed THEN round(list_sum(list_transform(range(64),
         lambda i: x[i + 1] * list_sum(list_transform(range(8), lambda j: (((7 * i + 13 * j) % 17) - 8) / 8.0)))), 5) END AS total FROM f""")
def q_featurize_failures(spark, sf_dir):
    """Rows that cannot be processed (missing or short vectors) fail alone: no
    features, an error, and the rest of their batch unharmed."""
    from lumisort.catalog.fixtures import EMBEDDING_DIM, PROJECTION_DIM
    from lumisort.operators.featurize import featurize, projection_model
    k = F.col("vec_id") % 10
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.when(k == 5, F.lit(None)).when(
        k == 3, F.slice("embedding", 1, EMBEDDING_DIM - 1)).otherwise(F.col("embedding")).alias("v"))
    f = featurize(emb, projection_model(EMBEDDING_DIM, PROJECTION_DIM), "v", batch_size=64)
    return f.select("vec_id", (F.col("features").isNull() & F.col("error").isNotNull()).alias("failed"),
                    F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


def _image_sql() -> str:
    from lumisort.operators.featurize import BGR_MEANS
    return f"""WITH px AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(abs(x) * 1000) % 256) AS b FROM embeddings),
cell AS (SELECT vec_id, r, c, k, b[(2 * r) * 8 + 2 * c + 1] - [{', '.join(map(repr, BGR_MEANS))}][k + 1] AS v
         FROM px, range(4) a(r), range(4) d(c), range(3) e(k))
SELECT vec_id, CAST(j AS BIGINT) AS dim, CASE WHEN vec_id % 25 <> 4 THEN
         round(sum(v * (((7 * ((r * 4 + c) * 3 + k) + 13 * j) % 17) - 8) / 8.0), 6) END AS value
FROM cell, range(5) o(j) GROUP BY vec_id, j"""


def _grey_image():
    """An 8 x 8 grey image as Spark's image source gives it, made of the embedding; some lack a byte."""
    hexes = F.transform("embedding", lambda x: F.lpad(F.hex((F.floor(F.abs(x.cast("double")) * 1000) % 256).cast("bigint")), 2, "0"))
    data = F.unhex(F.array_join(hexes, ""))
    data = F.when(F.col("vec_id") % 25 == 4, F.substring(data, 1, 63)).otherwise(data)
    return F.struct(F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), data.alias("data"))


@register("image_featurize", _image_sql())
def q_image_featurize(spark, sf_dir):
    """Image steps on given data: 8 x 8 grey images made of the embeddings, some
    with a byte missing; three channels, resize to 4 x 4, mean-centred, model."""
    from lumisort.operators.featurize import featurize, projection_model
    f = featurize(table(spark, sf_dir, "embeddings").select("vec_id", _grey_image().alias("image")), projection_model(48, 5), "image",
                  image_size=4)
    five = F.coalesce("features", F.array_repeat(F.lit(None).cast("double"), 5))
    return f.select("vec_id", F.posexplode(five).alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("long"), F.round("value", 6).alias("value"))


@register("stream_score", samples_ctes() + f"""
SELECT n.file_name, n.features IS NOT NULL AS success,
       CASE WHEN d.margin IS NULL THEN NULL WHEN d.margin > 0 THEN '{OVO_PAIR[0]}' ELSE '{OVO_PAIR[1]}' END AS prediction,
       round(d.margin, 6) AS margin, CASE WHEN n.features IS NULL THEN 'features: NULL vector' END AS error
FROM named n LEFT JOIN (SELECT file_name, list_dot_product(features, {W_SQL}) AS margin FROM named
                        WHERE features IS NOT NULL) d USING (file_name)""")
def q_stream_score(spark, sf_dir):
    """Structured Streaming over the embeddings files (availableNow): samples
    projection -> margin -> class name -> Parquet sink; returns the sink."""
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sources.samples import CLASS_NAMES, FAILED_EXTRACTION_MOD, FAILED_EXTRACTION_REM, samples_from_table
    from lumisort.streaming.score_stream import score_stream, stream_table
    src = stream_table(spark, f"{sf_dir.rstrip('/')}/embeddings.parquet", "vec_id bigint, embedding array<float>, label int")
    failed = (F.col("vec_id") % FAILED_EXTRACTION_MOD) == FAILED_EXTRACTION_REM
    s = samples_from_table(src, "vec_id", "embedding", "label", CLASS_NAMES, failed)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    q = score_stream(s, PROBE_MODEL, (OVO_PAIR[1], OVO_PAIR[0]), sink, ckpt)
    q.awaitTermination()
    out = durable(spark.read.schema("file_name string, success boolean, prediction string, margin double, error string")
                  .parquet(sink))
    remove_scratch(spark, sink)
    remove_scratch(spark, ckpt)
    return out.select("file_name", "success", "prediction", F.round("margin", 6).alias("margin"), "error")


@register("stream_scored_once", ORACLE["stream_score"])
def q_stream_scored_once(spark, sf_dir):
    """Embeddings as a stream in which every row comes twice, run a second time from the start: one reply a name."""
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sources.samples import CLASS_NAMES, FAILED_EXTRACTION_MOD, FAILED_EXTRACTION_REM, samples_from_table
    from lumisort.streaming.score_stream import commit_stream, first_of_key, reply_table, score_frame, stream_table
    root = scratch_path(spark, "replies")
    table = reply_table(spark, root)
    failed = (F.col("vec_id") % FAILED_EXTRACTION_MOD) == FAILED_EXTRACTION_REM
    for name in ("first", "second"):
        src = stream_table(spark, f"{sf_dir.rstrip('/')}/embeddings.parquet", "vec_id bigint, embedding array<float>, label int")
        src = src.select("*", F.col("_metadata.file_modification_time").alias("at"), F.explode(F.array(F.lit(0), F.lit(1))))
        src = first_of_key(src, ["vec_id"], "at")
        s = samples_from_table(src, "vec_id", "embedding", "label", CLASS_NAMES, failed)
        ckpt = scratch_path(spark, "replies-ckpt")
        commit_stream(score_frame(s, PROBE_MODEL, (OVO_PAIR[1], OVO_PAIR[0])), table, name, ckpt).awaitTermination()
        remove_scratch(spark, ckpt)
    out = durable(table.read())
    remove_scratch(spark, root)
    return out.select("file_name", "success", "prediction", F.round("margin", 6).alias("margin"), "error")


IMAGE_WEIGHTS = [0.02, -0.05, 0.03, 0.04, -0.01]


def _image_score_sql() -> str:
    return "WITH f AS (" + _image_sql() + f"""),
v AS (SELECT vec_id, bool_and(value IS NOT NULL) AS ok, sum(value * list_extract({sql_list(IMAGE_WEIGHTS)}, dim + 1)) AS margin FROM f GROUP BY vec_id)
SELECT CAST(vec_id AS VARCHAR) || '.png' AS file_name, ok AS success,
       CASE WHEN ok THEN CASE WHEN margin > 0 THEN 'yes' ELSE 'no' END END AS prediction,
       CASE WHEN ok THEN round(margin, 5) END AS margin, CASE WHEN NOT ok THEN 'decode: size mismatch' END AS error FROM v"""


@register("stream_image_score", _image_score_sql())
def q_stream_image_score(spark, sf_dir):
    """Images as a stream (8 x 8 grey ones made of the embeddings, some with a byte missing), decoded, featurised and
    scored per micro-batch; one reply a name."""
    from lumisort.operators.featurize import projection_model
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.streaming.score_stream import commit_stream, reply_table, score_frame, stream_table
    src = stream_table(spark, f"{sf_dir.rstrip('/')}/embeddings.parquet", "vec_id bigint, embedding array<float>, label int")
    images = src.select(F.concat(F.col("vec_id").cast("string"), F.lit(".png")).alias("file_name"), _grey_image().alias("image"))
    root, ckpt = scratch_path(spark, "image-replies"), scratch_path(spark, "image-replies-ckpt")
    table = reply_table(spark, root)
    scored = score_frame(images, LinearModel(IMAGE_WEIGHTS, 0.0, "svm"), ("no", "yes"), model_fn=projection_model(48, 5), image_size=4)
    commit_stream(scored, table, "images", ckpt).awaitTermination()
    out = durable(table.read())
    remove_scratch(spark, root)
    remove_scratch(spark, ckpt)
    return out.select("file_name", "success", "prediction", F.round("margin", 5).alias("margin"), "error")


# ------------------------------------------------------ sink -> source trips

@register("feature_table_reruns", samples_ctes() + """
SELECT file_name, label_name, split, features IS NULL AS is_null, CAST(len(features) AS BIGINT) AS n,
       round(list_sum(features), 6) AS total FROM samples""")
def q_feature_table_reruns(spark, sf_dir):
    """Features committed in runs: some rows, the same run again, an attempt that dies before its commit, all rows,
    rows that replace others, and the versions folded into one."""
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sinks.committed import feature_table
    s = _samples(spark, sf_dir).withColumn("error", F.lit(None).cast("string"))
    some = F.substring("file_name", -6, 1).isin("1", "2", "5")
    root = scratch_path(spark, "feature-table")
    table = feature_table(spark, root)
    wrong = F.array(F.lit(0.5))
    table.append(s.where(some).withColumn("features", wrong), "a")
    table.append(s.where(some), "a")
    table._write_attempt(s, "died")
    table.append(s, "b")
    table.replace(s.where(some), "c")
    table.compact()
    table.clean()
    out = durable(table.read().select(
        "file_name", "label_name", "split", F.col("features").isNull().alias("is_null"), F.size("features").cast("long").alias("n"),
        F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total")))
    remove_scratch(spark, root)
    return out


@register("feature_roundtrip", samples_ctes() + """
SELECT file_name, label_name, split, features IS NULL AS is_null, CAST(len(features) AS BIGINT) AS n,
       round(list_sum(features), 6) AS total FROM samples""")
def q_feature_roundtrip(spark, sf_dir):
    """Write the feature table (JSON lines, partitioned by split and class) to
    the shared folder and read it back with the feature reader."""
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sinks.writers import write_features
    from lumisort.sources.files import path_of_uri, read_feature_json
    path = scratch_path(spark, "features-json")
    write_features(_samples(spark, sf_dir), path, fmt="json", mode="overwrite")
    back = read_feature_json(spark, path, layout="lines").withColumn(
        "split", F.regexp_extract(path_of_uri("_metadata.file_path"), r"/split=([^/]+)/", 1)).withColumn(
        "label_name", F.regexp_extract(path_of_uri("_metadata.file_path"), r"/label_name=([^/]+)/", 1))
    out = durable(back.select("file_name", "label_name", "split", F.col("features").isNull().alias("is_null"),
                              F.size("features").cast("long").alias("n"),
                              F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total")))
    remove_scratch(spark, path)
    return out


def _results_sql() -> str:
    sql = _pivot_sql()
    head, _sep, _tail = sql.rpartition("SELECT class1, class0,")
    return head + """SELECT class1, class0, CAST(split_part(train_test, '/', 1) AS DOUBLE) AS cutoff, train_test,
       round(accuracy, 6) AS accuracy FROM acc"""


@register("results_roundtrip", _results_sql())
def q_results_roundtrip(spark, sf_dir):
    """The fixed-model grid results written as CSV and read back (S9/K7)."""
    from lumisort.plans.grid import score_grid
    from lumisort.session import durable, remove_scratch, scratch_path
    from lumisort.sinks.writers import write_results
    from lumisort.sources.files import read_results
    res = score_grid(_samples(spark, sf_dir), PROBE_MODEL, GRID_CLASSES, GRID_CUTOFFS, seed=SEED)
    res = res.select("class1", "class0", "cutoff", "train_test", F.round("accuracy", 6).alias("accuracy"))
    path = scratch_path(spark, "results-csv")
    write_results(res, path)
    out = durable(read_results(spark, path, "class1 string, class0 string, cutoff double, train_test string, accuracy double"))
    remove_scratch(spark, path)
    return out

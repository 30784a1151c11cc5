"""Features, reduction, clustering and model choice as registered queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import schemas
from larder.functions import scalars as S
from larder.operators import blocks as BL
from larder.operators import clustering as K
from larder.operators import density as D
from larder.operators import evaluation as E
from larder.operators import features as FT
from larder.operators import hierarchy as H
from larder.operators import reduction as R
from larder.operators.aggregates import matrix_range as matrix_range_of
from larder.operators.aggregates import frequency_shares
from larder.plans import pipeline as P
from larder.plans.registry import query
from larder.plans.relational import big, inventory, rounded
from larder.plans.views import tokens_sql, with_views
from larder.session import cut, scratch_path, spread_scan
from larder.sources import bindings as B
from larder.sources import tables as T


# --- text ----------------------------------------------------------------------------------------------------------


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread_scan(B.table(spark, d, "documents").select("doc_id", "text"), "doc_id")


@query(
    "tokenize",
    f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct,
          array_to_string(t, ' ') AS token_text FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)""",
)
def tokenize(spark, d):
    docs = _documents(spark, d).select("doc_id", S.tokens(F.col("text")).alias("t"))
    return big(
        docs.select(
            "doc_id",
            F.size("t").alias("n_tokens"),
            F.size(F.array_distinct("t")).alias("n_distinct"),
            F.array_join("t", " ").alias("token_text"),
        )
    )


NAMES = "names AS (SELECT coalesce(product_name, '') AS name, count(*) AS n FROM inventory GROUP BY 1)"


def _vocab_sql(source: str, key: str, text: str, weight: str, k: int) -> str:
    """terms -> (key, term, tf), vocab -> (term, total, idf, pos), tfidf -> (key, term, weight)."""
    return f"""spread AS (SELECT {key} AS k, {weight} AS w, unnest({tokens_sql(text)}) AS term FROM {source}),
      tf AS (SELECT k, term, w, count(*) AS tf FROM spread GROUP BY 1, 2, 3),
      vocab AS (SELECT term, total, ln((1.0e0 + (SELECT sum({weight}) FROM {source})) / (1.0e0 + df)) + 1.0e0 AS idf,
          row_number() OVER (ORDER BY term) AS pos
        FROM (SELECT term, sum(tf * w) AS total, sum(w) AS df FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT {k})),
      tfidf AS (SELECT k, term, pos, x / sqrt(sum(x * x) OVER (PARTITION BY k)) AS weight
        FROM (SELECT k, term, pos, tf * idf AS x FROM tf JOIN vocab USING (term)))"""


def _vocabulary_rows(spark: SparkSession, v: FT.Vocabulary) -> DataFrame:
    return rounded(spark.createDataFrame(list(zip(v.terms, v.totals, v.idf, strict=True)), "term string, total long, idf double"), 6, "idf")


@query(
    "tfidf_vocab",
    with_views(
        "inventory",
        f"WITH {NAMES}, {_vocab_sql('names', 'name', 'name', 'n', FT.MAX_FEATURES)} "
        "SELECT term, CAST(total AS BIGINT) AS total, round(idf, 6) AS idf FROM vocab",
    ),
)
def tfidf_vocab(spark, d):
    names = inventory(spark, d).groupBy(F.coalesce("product_name", F.lit("")).alias("name")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return _vocabulary_rows(spark, FT.fit_vocabulary(names, "name", F.col("n"), FT.MAX_FEATURES))


@query(
    "tfidf_vocab_documents",
    f"""WITH {_vocab_sql('documents', 'doc_id', 'text', '1', 50)}
        SELECT term, CAST(total AS BIGINT) AS total, round(idf, 6) AS idf FROM vocab""",
)
def tfidf_vocab_documents(spark, d):
    return _vocabulary_rows(spark, FT.weigh_terms(_documents(spark, d), ["doc_id"], "text", 50)[1])


@query(
    "tfidf_weights",
    with_views(
        "inventory",
        f"WITH {NAMES}, {_vocab_sql('names', 'name', 'name', 'n', FT.MAX_FEATURES)} "
        "SELECT k AS name, term, round(weight, 6) AS weight FROM tfidf",
    ),
)
def tfidf_weights(spark, d):
    weights, vocabulary = FT.name_weights(inventory(spark, d), FT.MAX_FEATURES)
    return rounded(FT.long_weights(weights, ["name"], "txt", vocabulary), 6, "weight")


@query(
    "tfidf_weights_documents",
    f"""WITH {_vocab_sql('documents', 'doc_id', 'text', '1', 50)}
        SELECT k AS doc_id, term, round(weight, 6) AS weight FROM tfidf""",
)
def tfidf_weights_documents(spark, d):
    weights, vocabulary = FT.weigh_terms(_documents(spark, d), ["doc_id"], "text")
    return rounded(FT.long_weights(weights, ["doc_id"], "txt", vocabulary), 6, "weight")


# --- numeric features ----------------------------------------------------------------------------------------------

IMPUTED = """imputed AS (SELECT row_id, event_type, timestamp, product_name, category, {0} FROM inventory)""".format(
    ", ".join(
        f"CASE WHEN category IS NULL THEN 0.0e0 ELSE coalesce({c}, avg({c}) OVER (PARTITION BY category), 0.0e0) END AS {c}"
        for c in schemas.NUTRIENTS
    )
)


@query(
    "impute_category_mean",
    with_views(
        "inventory",
        f"WITH {IMPUTED} SELECT row_id, {', '.join(f'round({c}, 6) AS {c}' for c in schemas.NUTRIENTS)} FROM imputed",
    ),
)
def impute_category_mean(spark, d):
    filled = FT.impute_category_mean(inventory(spark, d)).select("row_id", *schemas.NUTRIENTS)
    return rounded(filled, 6, *schemas.NUTRIENTS)


ENCODED = """encoded AS (SELECT row_id, category,
    (coalesce(sum(y) OVER w, 0) + (SELECT avg(CASE WHEN event_type = 'OUT' THEN 1.0e0 ELSE 0.0e0 END) FROM inventory))
      / (count(*) OVER w + 1) AS category_encoded
  FROM (SELECT row_id, category, CASE WHEN event_type = 'OUT' THEN 1 ELSE 0 END AS y FROM inventory)
  WINDOW w AS (PARTITION BY category ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
ENCODED_SQL = with_views(
    "inventory", f"WITH {ENCODED} SELECT row_id, round(category_encoded, 9) AS category_encoded FROM encoded"
)


@query("target_encode_ordered", ENCODED_SQL)
def target_encode_ordered(spark, d):
    encoded = FT.target_encode_ordered(inventory(spark, d).select("row_id", "event_type", "category"))
    return rounded(encoded.select("row_id", "category_encoded"), 9, "category_encoded")


@query("target_encode_split", ENCODED_SQL)
def target_encode_split(spark, d):
    """The same encoding with every category treated as hot."""
    narrow = inventory(spark, d).select("row_id", "event_type", "category")
    encoded = FT.target_encode_ordered(narrow, hot_rows=0)
    return rounded(encoded.select("row_id", "category_encoded"), 9, "category_encoded")


@query(
    "target_encode_static",
    with_views(
        "inventory",
        """WITH prior AS (SELECT avg(CASE WHEN event_type = 'OUT' THEN 1.0e0 ELSE 0.0e0 END) AS p FROM inventory),
          level AS (SELECT category, sum(CASE WHEN event_type = 'OUT' THEN 1 ELSE 0 END) AS s, count(*) AS n
            FROM inventory GROUP BY 1)
          SELECT q.product_id, CAST(q.department_id AS BIGINT) AS category,
            round(coalesce((l.s + p) / (l.n + 1), p), 9) AS category_encoded
          FROM products q CROSS JOIN prior LEFT JOIN level l ON l.category IS NOT DISTINCT FROM q.department_id""",
    ),
)
def target_encode_static(spark, d):
    products = B.products(spark, d).select("product_id", F.col("department_id").alias("category"))
    return rounded(big(FT.target_encode_static(inventory(spark, d), products)), 9, "category_encoded")


STANDARD_COLS = [*schemas.NUTRIENTS, "hour_of_day", "day_of_week"]


def _scaled(cols: list[str], source: str) -> str:
    parts = ", ".join(
        f"round(CASE WHEN stddev_pop({c}) OVER () <= 1e-12 THEN 0.0e0 ELSE "
        f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END + 0.0e0, 6) + 0.0e0 AS {c}"
        for c in cols
    )
    return f"SELECT row_id, {parts} FROM {source}"


@query(
    "standardize",
    with_views(
        "inventory",
        f"""WITH {IMPUTED}, timed AS (SELECT *, CAST(hour(timestamp) AS DOUBLE) AS hour_of_day,
            CAST(isodow(timestamp) - 1 AS DOUBLE) AS day_of_week FROM imputed) {_scaled(STANDARD_COLS, 'timed')}""",
    ),
)
def standardize(spark, d):
    ts = F.col("timestamp")
    rows = FT.impute_category_mean(inventory(spark, d)).select(
        "row_id",
        F.array(
            *schemas.NUTRIENTS, S.hour_of_day(ts).cast("double"), S.day_of_week(ts).cast("double")
        ).alias("features"),
    )
    scaled = FT.standardize(rows, "features", len(STANDARD_COLS))
    return scaled.select(
        "row_id", *[(F.round(F.element_at("features", i + 1), 6) + 0.0).alias(c) for i, c in enumerate(STANDARD_COLS)]
    )


MATRIX = f"""WITH {NAMES}, {_vocab_sql('names', 'name', 'name', 'n', FT.MAX_FEATURES)}, {IMPUTED}, {ENCODED},
  base AS (SELECT i.*, e.category_encoded, coalesce(i.product_name, '') AS name FROM imputed i JOIN encoded e USING (row_id)),
  raw AS (
    SELECT row_id, 1 AS pos, 'calories_100g' AS name, calories_100g AS x FROM base
    UNION ALL SELECT row_id, 2, 'proteins_100g', proteins_100g FROM base
    UNION ALL SELECT row_id, 3, 'carbs_100g', carbs_100g FROM base
    UNION ALL SELECT row_id, 4, 'category_encoded', category_encoded FROM base
    UNION ALL SELECT b.row_id, 4 + v.pos, 'txt_' || v.term, coalesce(t.weight, 0.0e0)
      FROM base b CROSS JOIN vocab v LEFT JOIN tfidf t ON t.k = b.name AND t.term = v.term
    UNION ALL SELECT row_id, 5 + (SELECT count(*) FROM vocab), 'hour_of_day', CAST(hour(timestamp) AS DOUBLE) FROM base
    UNION ALL SELECT row_id, 6 + (SELECT count(*) FROM vocab), 'day_of_week', CAST(isodow(timestamp) - 1 AS DOUBLE) FROM base),
  fm AS (SELECT row_id, pos, r.name, CASE WHEN sd <= 1e-12 THEN 0.0e0 ELSE (x - mean) / sd END AS x
    FROM raw r JOIN (SELECT pos, avg(x) AS mean, stddev_pop(x) AS sd FROM raw GROUP BY 1) USING (pos))"""
MATRIX_SQL = with_views(
    "inventory", MATRIX + " SELECT row_id, CAST(pos AS BIGINT) AS pos, round(x, 6) + 0.0e0 AS value FROM fm"
)


def _long(matrix: DataFrame) -> DataFrame:
    spread = matrix.select("row_id", F.posexplode("features").alias("pos", "value"))
    return spread.select("row_id", (F.col("pos") + 1).cast("bigint").alias("pos"), (F.round("value", 6) + 0.0).alias("value"))


@query("feature_matrix", MATRIX_SQL)
def feature_matrix(spark, d):
    return _long(FT.feature_matrix(inventory(spark, d), FT.MAX_FEATURES)[0])


@query("roundtrip_features", MATRIX_SQL)
def roundtrip_features(spark, d):
    path = scratch_path(spark, "features")
    T.write_matrix(FT.feature_matrix(inventory(spark, d), FT.MAX_FEATURES)[0], path)
    return _long(T.read_matrix(spark, path))


@query(
    "feature_names",
    with_views("inventory", MATRIX + " SELECT DISTINCT CAST(pos AS BIGINT) AS pos, name FROM fm"),
)
def feature_names(spark, d):
    names = FT.feature_matrix(inventory(spark, d), FT.MAX_FEATURES)[1]
    return big(T.feature_names_table(spark, names))


@query(
    "scaled_check",
    with_views(
        "inventory",
        MATRIX
        + """ SELECT CAST(pos AS BIGINT) AS pos, round(avg(x), 6) + 0.0e0 AS mean, round(var_pop(x), 6) + 0.0e0 AS variance
            FROM fm GROUP BY 1""",
    ),
)
def scaled_check(spark, d):
    matrix, names = FT.feature_matrix(inventory(spark, d), FT.MAX_FEATURES)
    spread = matrix.select(F.posexplode("features").alias("pos", "x"))
    return spread.groupBy((F.col("pos") + 1).cast("bigint").alias("pos")).agg(
        (F.round(F.avg("x"), 6) + 0.0).alias("mean"), (F.round(F.var_pop("x"), 6) + 0.0).alias("variance")
    )


@query(
    "matrix_range",
    """SELECT count(*) AS n_rows, CAST(max(len(embedding)) AS BIGINT) AS n_cols,
         CAST(min(list_min(embedding)) AS DOUBLE) AS min_value, CAST(max(list_max(embedding)) AS DOUBLE) AS max_value
       FROM embeddings""",
)
def matrix_range(spark, d):
    return matrix_range_of(B.embeddings(spark, d))


# --- reduction -----------------------------------------------------------------------------------------------------


def reduced(spark: SparkSession, d: str) -> tuple[DataFrame, R.Components, list[str]]:
    matrix, names = FT.feature_matrix(inventory(spark, d), FT.MAX_FEATURES)
    matrix = cut(matrix)  # scanned four times and more
    return matrix, R.fit_components(matrix), names


@query("pca_scree")
def pca_scree(spark, d):
    return R.scree(spark, reduced(spark, d)[1])


@query("pca_energy_table")
def pca_energy_table(spark, d):
    return R.energy_table(R.scree(spark, reduced(spark, d)[1]))


@query(
    "variance_threshold",
    """SELECT CAST(min(hour) AS BIGINT) AS n FROM (SELECT hour, sum(share) OVER (ORDER BY hour) AS c FROM (
         SELECT hour(ts) AS hour, count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE) AS share FROM events GROUP BY 1))
       WHERE c >= 0.9e0""",
)
def variance_threshold(spark, d):
    shares = frequency_shares(B.table(spark, d, "events").select(F.hour("ts").alias("hour")), "hour", 12)
    return big(R.first_reaching(shares, "hour", "share", R.VARIANCE_KEPT))


POWERS = 8


def _power_sums_sql() -> str:
    """Traces of the powers of the correlation matrix, divided by its trace: the sums of the powers of the components' shares."""
    steps = ",\n".join(
        f"p{k} AS MATERIALIZED (SELECT a.i, b.j, sum(a.c * b.c) AS c FROM p{k - 1} a JOIN p1 b ON a.j = b.i GROUP BY 1, 2)" for k in range(2, POWERS + 1)
    )
    traces = " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS power, round(sum(c), 9) AS power_sum FROM p{k} WHERE i = j" for k in range(1, POWERS + 1))
    return with_views(
        "inventory",
        f"""{MATRIX}, cov AS MATERIALIZED (SELECT a.pos AS i, b.pos AS j, covar_samp(a.x, b.x) AS c FROM fm a JOIN fm b USING (row_id) GROUP BY 1, 2),
          p1 AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM cov WHERE i = j) AS c FROM cov), {steps} {traces}""",
    )


@query("pca_power_sums", _power_sums_sql())
def pca_power_sums(spark, d):
    """Sums of the first powers of the shares of variance, which fix the shares themselves."""
    ratio = np.asarray(reduced(spark, d)[1].ratio)
    rows = [(k, float((ratio**k).sum())) for k in range(1, POWERS + 1)]
    return rounded(spark.createDataFrame(rows, "power long, power_sum double"), 9, "power_sum")


@query(
    "pca_row_norms",
    with_views("inventory", MATRIX + " SELECT row_id, round(sum(x * x), 6) AS squared_norm FROM fm GROUP BY 1"),
)
def pca_row_norms(spark, d):
    """All coordinates of a row together are as long as the row: nothing is lost or stretched by the projection."""
    matrix, c, names = reduced(spark, d)
    scored = R.project(matrix, c, len(names))
    norm = F.aggregate("pca", F.lit(0.0), lambda acc, x: acc + x * x)
    return rounded(scored.select("row_id", norm.alias("squared_norm")), 6, "squared_norm")


@query(
    "pca_loading_norms",
    with_views(
        "inventory",
        MATRIX + """, cov AS (SELECT a.pos AS i, b.pos AS j, min(a.name) AS a, min(b.name) AS b, covar_samp(a.x, b.x) AS c
            FROM fm a JOIN fm b USING (row_id) WHERE a.pos <= b.pos GROUP BY 1, 2) SELECT a AS feature_a, b AS feature_b, round(c, 6) + 0.0e0 AS covariance FROM cov""",
    ),
)
def pca_loading_norms(spark, d):
    """Products of the loadings of every two features over all components: their covariance."""
    _, c, names = reduced(spark, d)
    table = {r["feature"]: np.array([r[f"l{i + 1}"] for i in range(len(names))]) for r in R.loadings(spark, c, names, len(names)).collect()}
    rows = [(a, b, float(table[a] @ table[b])) for i, a in enumerate(names) for b in names[i:]]
    return spark.createDataFrame(rows, "feature_a string, feature_b string, covariance double").withColumn("covariance", F.round("covariance", 6) + 0.0)


@query("pca_reduced")
def pca_reduced(spark, d):
    matrix, c, _ = reduced(spark, d)
    scored = R.project(matrix, c, R.components_for(c))
    return scored.select("row_id", F.transform("pca", lambda x: F.round(x, 6)).alias("pca"))


@query("pca_2d")
def pca_2d(spark, d):
    matrix, c, _ = reduced(spark, d)
    flat = R.project(matrix, c, 2).select(
        "row_id", F.round(F.col("pca")[0], 6).alias("pc1"), F.round(F.col("pca")[1], 6).alias("pc2")
    )
    events = B.movements(spark, d).select("row_id", "event_type")
    return events.join(flat, "row_id")


@query("pca_loadings")
def pca_loadings(spark, d):
    _, c, names = reduced(spark, d)
    return R.loadings(spark, c, names)


@query("top_loadings")
def top_loadings(spark, d):
    _, c, names = reduced(spark, d)
    return R.top_loadings(R.loadings(spark, c, names))


def _centred_embeddings(spark: SparkSession, d: str) -> DataFrame:
    rows = B.embeddings(spark, d)
    width = len(rows.select("features").first()[0])
    means, _ = FT.column_stats(rows, "features", width)
    centre = F.array(*[F.lit(m) for m in means])
    return rows.withColumn("features", F.zip_with("features", centre, lambda x, m: x - m))


COVARIANCE = """WITH cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  cov AS (SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS c FROM cells a JOIN cells b ON a.vec_id = b.vec_id GROUP BY 1, 2)
  SELECT round(sum(c) FILTER (WHERE i = j), 6) AS total_variance, round(sum(c * c), 6) AS squared_variance FROM cov"""


@query("pca_moments", COVARIANCE)
def pca_moments(spark, d):
    """Sum and sum of squares of the component variances: trace and squared norm of the covariance matrix."""
    c = R.fit_components(_centred_embeddings(spark, d))
    rows = [(float(c.variance.sum()), float((c.variance**2).sum()))]
    return rounded(
        spark.createDataFrame(rows, "total_variance double, squared_variance double"), 6, "total_variance", "squared_variance"
    )


@query("svd_moments", COVARIANCE)
def svd_moments(spark, d):
    """The same two sums from the singular values."""
    rows = _centred_embeddings(spark, d)
    values = R.svd_variances(rows, len(rows.select("features").first()[0]))
    sums = values.agg(
        F.sum("variance").alias("total_variance"), F.sum(F.col("variance") ** 2).alias("squared_variance")
    )
    return rounded(sums, 6, "total_variance", "squared_variance")


@query("svd_variance")
def svd_variance(spark, d):
    matrix, c, names = reduced(spark, d)
    by_svd = R.svd_variances(matrix, len(names))
    by_pca = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(c.variance)], "pc int, pca_variance double")
    return by_pca.join(by_svd, "pc", "left")


# --- clustering ----------------------------------------------------------------------------------------------------


@query(
    "kmeans_assign",
    """WITH c AS (SELECT label, arg_min(embedding, vec_id) AS centre FROM embeddings GROUP BY 1),
       dist AS (SELECT vec_id, label, list_distance(embedding::DOUBLE[], centre::DOUBLE[]) AS dist FROM (
         SELECT e.vec_id, c.label, e.embedding, c.centre FROM embeddings e CROSS JOIN c))
       SELECT vec_id AS row_id, CAST(arg_min(label, (dist, label)) AS BIGINT) AS cluster_label,
         round(min(dist) * min(dist), 6) AS sq_distance FROM dist GROUP BY 1""",
)
def kmeans_assign(spark, d):
    rows = B.embeddings(spark, d)
    # One centre per label: as many rows as there are labels.
    first = rows.groupBy("cluster_label").agg(F.min_by("features", "row_id").alias("c")).orderBy("cluster_label").collect()
    labelled = K.assign_to_centres(rows, np.array([r["c"] for r in first]))
    names = F.array(*[F.lit(int(r["cluster_label"])) for r in first])
    named = labelled.withColumn("cluster_label", F.element_at(names, F.col("cluster_label") + 1))
    return rounded(big(named), 6, "sq_distance")


@query(
    "inertia",
    """WITH cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
       m AS (SELECT label, i, avg(x) AS m FROM cells GROUP BY 1, 2)
       SELECT round(sum((x - m) * (x - m)), 6) AS inertia, count(DISTINCT label) AS n_clusters FROM cells JOIN m USING (label, i)""",
)
def inertia(spark, d):
    return rounded(E.inertia(B.embeddings(spark, d)), 6, "inertia")


def _silhouette_sql(distance: str) -> str:
    return f"""WITH d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS s, count(*) AS n
        FROM embeddings a JOIN embeddings b ON true GROUP BY 1, 2, 3),
      ab AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
        min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY 1)
      SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette"""


DIST = "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query("silhouette_exact", _silhouette_sql(DIST) + ", count(*) AS n_rows FROM ab")
def silhouette_exact(spark, d):
    rows = B.embeddings(spark, d).withColumn("labels", F.array("cluster_label"))
    return rounded(E.silhouette_exact(rows).drop("trial"), 6, "silhouette")


@query("silhouette_fast", _silhouette_sql(f"{DIST} * {DIST}") + " FROM ab")
def silhouette_fast(spark, d):
    score = E.silhouette_fast(B.embeddings(spark, d))
    return rounded(spark.createDataFrame([(score,)], "silhouette double"), 6, "silhouette")


@query("kmeans_sweep")
def kmeans_sweep(spark, d):
    return rounded(K.kmeans_sweep(B.vectors(spark, d)).results, 6, "silhouette", "metric")


@query("gmm_sweep")
def gmm_sweep(spark, d):
    return rounded(K.gmm_sweep(B.vectors(spark, d)).results, 6, "silhouette", "metric")


@query(
    "eps_neighbors",
    f"""SELECT a.vec_id AS row_id, count(*) AS n_neighbours FROM embeddings a JOIN embeddings b ON {DIST} <= 1.19e0
        GROUP BY 1""",
)
def eps_neighbors(spark, d):
    return D.eps_neighbours(B.embeddings(spark, d), 1.19)


@query(
    "dbscan_core",
    f"""SELECT a.vec_id AS row_id, count(*) AS n_neighbours, count(*) >= 5 AS is_core
        FROM embeddings a JOIN embeddings b ON {DIST} <= 1.19e0 GROUP BY 1""",
)
def dbscan_core(spark, d):
    return D.dbscan_core(B.embeddings(spark, d), 1.19, 5)


DISTANCES = """dist AS MATERIALIZED (SELECT a.row_id AS u, b.row_id AS v, list_distance(a.f, b.f) AS d FROM vectors a JOIN vectors b ON true)"""


def _roots_sql(name: str, key: str) -> str:
    """(key, u, root): the smallest u reachable over ``link`` (key, u, v) from each row of ``core`` (key, u), labels replaced in rounds."""
    return f"""{name}({key}, u, root) USING KEY ({key}, u) AS (SELECT {key}, u, u FROM core UNION
      SELECT link.{key}, link.v, min({name}.root) FROM {name} JOIN link ON link.{key} = {name}.{key} AND link.u = {name}.u
        JOIN recurring.{name} r ON r.{key} = link.{key} AND r.u = link.v WHERE {name}.root < r.root GROUP BY 1, 2)"""


def _dbscan_sql(grid: list[tuple[float, int]], tail: str) -> str:
    rows = ", ".join(f"({i}, CAST({e} AS DOUBLE), {m})" for i, (e, m) in enumerate(grid))
    return with_views(
        "vectors",
        f"""WITH RECURSIVE {DISTANCES}, grid AS (SELECT * FROM (VALUES {rows}) g(trial, eps, min_samples)),
          near AS MATERIALIZED (SELECT eps, u, v FROM dist JOIN (SELECT DISTINCT eps FROM grid) ON d <= eps),
          core AS MATERIALIZED (SELECT trial, eps, u FROM (SELECT eps, u, count(*) AS n FROM near GROUP BY 1, 2) JOIN grid USING (eps)
            WHERE n >= min_samples),
          link AS MATERIALIZED (SELECT a.trial, n.u, n.v FROM near n JOIN core a ON a.eps = n.eps AND a.u = n.u
            JOIN core b ON b.trial = a.trial AND b.u = n.v),
          {_roots_sql('comp', 'trial')},
          border AS (SELECT c.trial, n.v AS u, min(c.root) AS root FROM near n JOIN grid USING (eps)
            JOIN comp c ON c.trial = grid.trial AND c.u = n.u GROUP BY 1, 2),
          member AS (SELECT trial, u, root FROM comp UNION ALL SELECT * FROM border ANTI JOIN comp USING (trial, u)),
          ranked AS (SELECT trial, root, dense_rank() OVER (PARTITION BY trial ORDER BY root) - 1 AS cluster_label
            FROM (SELECT DISTINCT trial, root FROM comp)),
          labelled AS (SELECT g.trial, g.eps, g.min_samples, b.row_id, coalesce(k.cluster_label, -1) AS cluster_label
            FROM vectors b CROSS JOIN grid g LEFT JOIN member m ON m.trial = g.trial AND m.u = b.row_id
            LEFT JOIN ranked k ON k.trial = m.trial AND k.root = m.root)
          {tail}""",
    )


@query(
    "dbscan_labels",
    _dbscan_sql([(2.5, 30)], "SELECT row_id, CAST(cluster_label AS BIGINT) AS cluster_label FROM labelled"),
)
def dbscan_labels(spark, d):
    return big(D.dbscan(B.vectors(spark, d), 2.5, 30))


@query(
    "dbscan_sweep",
    _dbscan_sql(
        D.DBSCAN_GRID,
        """SELECT CAST(trial AS BIGINT) AS trial, count(DISTINCT cluster_label) FILTER (WHERE cluster_label >= 0) AS n_clusters,
             round(avg(CASE WHEN cluster_label < 0 THEN 1.0e0 ELSE 0.0e0 END), 6) AS noise_ratio FROM labelled GROUP BY 1""",
    ),
)
def dbscan_sweep(spark, d):
    labelled = D.dbscan_trials(B.vectors(spark, d), D.DBSCAN_GRID)
    return rounded(big(E.cluster_quality(labelled, by=["trial"])), 6, "noise_ratio")


CORE = f"{DISTANCES}, near AS (SELECT u, list_sort(list(d))[10] AS core FROM dist GROUP BY 1)"


@query("core_distances", with_views("vectors", f"WITH {CORE} SELECT u AS row_id, round(core, 6) AS core FROM near"))
def core_distances(spark, d):
    points = BL.distinct_points(B.vectors(spark, d))
    cores, _, _ = H.core_distances(points, 10)
    return rounded(points.to_rows(cores.select("pid", "core")), 6, "core")


@query(
    "core_distance_grid",
    with_views(
        "vectors",
        f"""WITH {DISTANCES}, sorted AS (SELECT u, list_sort(list(d)) AS l FROM dist GROUP BY 1)
          SELECT u AS row_id, CAST(k AS BIGINT) AS min_cluster_size, round(l[k], 6) AS core FROM sorted
          CROSS JOIN (VALUES {', '.join(f'({k})' for k in H.HDBSCAN_GRID)}) g(k)""",
    ),
)
def core_distance_grid(spark, d):
    """Core distances of every size of the grid, from one pass over the distances."""
    points = BL.distinct_points(B.vectors(spark, d))
    cores, _, _ = H.neighbour_distances(points, H.HDBSCAN_GRID)
    sizes = F.array(*[F.lit(k) for k in H.HDBSCAN_GRID])
    rows = points.to_rows(cores.select("pid", "cores")).select("row_id", F.inline(F.arrays_zip(sizes.alias("min_cluster_size"), "cores")))
    return rounded(big(rows.withColumnRenamed("cores", "core")), 6, "core")


LEVELS = [2.45, 2.5, 2.55, 2.7]


@query(
    "reachability_components",
    with_views(
        "vectors",
        f"""WITH RECURSIVE {CORE}, core AS (SELECT level, row_id AS u FROM vectors CROSS JOIN (VALUES {', '.join(f'(CAST({t} AS DOUBLE))' for t in LEVELS)}) t(level)),
          link AS MATERIALIZED (SELECT level, dist.u, dist.v FROM dist JOIN near a ON a.u = dist.u JOIN near b ON b.u = dist.v
            JOIN (SELECT DISTINCT level FROM core) ON greatest(d, a.core, b.core) <= level WHERE dist.u <> dist.v),
          {_roots_sql('comp', 'level')}
          SELECT level, count(DISTINCT root) AS n_components FROM comp GROUP BY 1""",
    ),
)
def reachability_components(spark, d):
    """Parts left at a level of mutual reachability: rows minus the spanning tree edges up to that level."""
    points = BL.distinct_points(B.vectors(spark, d))
    cores, packed, diameter = H.core_distances(points, 10)
    tree = H.spanning_tree(points, cores, packed, diameter)
    counts = tree.agg(*[F.count_if(F.col("w") <= t).alias(f"c{i}") for i, t in enumerate(LEVELS)])
    rows = [F.struct(F.lit(t).alias("level"), (points.n_distinct - F.col(f"c{i}")).alias("n_components")) for i, t in enumerate(LEVELS)]
    return counts.select(F.inline(F.array(*rows)))


@query("hdbscan_labels")
def hdbscan_labels(spark, d):
    return big(H.hdbscan(B.vectors(spark, d), 10))


# --- model choice --------------------------------------------------------------------------------------------------

TRIALS = """trials AS (SELECT CAST(user_id AS BIGINT) AS trial_no,
    CASE user_id % 4 WHEN 0 THEN 'K-Means' WHEN 1 THEN 'DBSCAN' WHEN 2 THEN 'GMM' ELSE 'HDBSCAN' END AS paradigm,
    'user=' || user_id AS params, round(avg(CASE WHEN event_type = 'purchase' THEN 1.0e0 ELSE 0.0e0 END), 6) AS silhouette, sum(value) AS metric,
    count(DISTINCT event_type) FILTER (WHERE event_type IN ('click', 'view')) AS n_clusters,
    round(avg(CASE WHEN event_type = 'error' THEN 1.0e0 ELSE 0.0e0 END), 6) AS noise_ratio FROM events GROUP BY user_id)"""
TRIAL_COLS = "trial_no, paradigm, params, silhouette, round(metric, 4) AS metric, n_clusters, noise_ratio"


def trials(spark: SparkSession, d: str) -> DataFrame:
    """A results table to choose from: one row per user of the event stream."""
    kind = F.element_at(
        F.array(*[F.lit(p) for p in ("K-Means", "DBSCAN", "GMM", "HDBSCAN")]), (F.col("user_id") % 4 + 1).cast("int")
    )
    event = F.col("event_type")
    per_user = B.table(spark, d, "events").groupBy("user_id").agg(
        F.round(F.avg((event == "purchase").cast("double")), 6).alias("silhouette"),
        F.sum("value").alias("metric"),
        F.count_distinct(F.when(event.isin("click", "view"), event)).alias("n_clusters"),
        F.round(F.avg((event == "error").cast("double")), 6).alias("noise_ratio"),
    )
    return per_user.select(
        F.col("user_id").alias("trial_no"),
        kind.alias("paradigm"),
        F.concat(F.lit("user="), F.col("user_id").cast("string")).alias("params"),
        "silhouette",
        "metric",
        "n_clusters",
        "noise_ratio",
    )


@query("gate_models", f"WITH {TRIALS} SELECT {TRIAL_COLS} FROM trials WHERE n_clusters >= 2 AND noise_ratio < 0.2e0")
def gate_models(spark, d):
    return rounded(E.gate(trials(spark, d), E.MAX_NOISE[2]), 4, "metric")


@query("best_model", f"WITH {TRIALS} SELECT {TRIAL_COLS} FROM trials ORDER BY silhouette DESC, trial_no LIMIT 1")
def best_model(spark, d):
    return rounded(E.best_model(trials(spark, d)), 4, "metric")


def _comparison_sql(phase: int) -> str:
    keep = "paradigm <> 'GMM' AND NOT (paradigm = 'K-Means' AND silhouette < 0.5e0)" if phase == 2 else "true"
    noise = {1: 0.6, 2: 0.2}[phase]
    return f"""WITH {TRIALS}, gated AS (SELECT trial_no, paradigm, params, metric, n_clusters, noise_ratio,
        CASE WHEN (paradigm IN ('DBSCAN', 'HDBSCAN') AND n_clusters < 2) OR (paradigm = 'DBSCAN' AND noise_ratio >= {noise}e0)
          THEN -1.0e0 ELSE silhouette END AS silhouette FROM trials WHERE {keep}),
      best AS (SELECT * FROM gated QUALIFY row_number() OVER (PARTITION BY paradigm ORDER BY silhouette DESC, trial_no) = 1)
      SELECT {TRIAL_COLS}, row_number() OVER (ORDER BY silhouette DESC, trial_no) = 1 AND silhouette > -1 AS winner FROM best"""


@query("model_comparison", _comparison_sql(1))
def model_comparison(spark, d):
    return rounded(E.model_comparison(trials(spark, d), 1), 4, "metric")


@query("model_comparison_refined", _comparison_sql(2))
def model_comparison_refined(spark, d):
    return rounded(E.model_comparison(trials(spark, d), 2), 4, "metric")


@query(
    "cluster_quality",
    """SELECT count(DISTINCT label) FILTER (WHERE label > 0) AS n_clusters,
         round(avg(CASE WHEN label = 0 THEN 1.0e0 ELSE 0.0e0 END), 6) AS noise_ratio FROM embeddings""",
)
def cluster_quality(spark, d):
    rows = B.embeddings(spark, d).withColumn("cluster_label", F.col("cluster_label") - 1)
    return rounded(E.cluster_quality(rows), 6, "noise_ratio")


# Moves of the centres before the labels of the segments are read off.
SEGMENT_STEPS = 5


def _segmented_sql() -> str:
    """K-Means on the whole feature matrix, from the mean of each category: centres are moved ``SEGMENT_STEPS`` times."""

    def nearest(i: int) -> str:
        return f"""l{i} AS MATERIALIZED (SELECT row_id, arg_min(k, (far, k)) AS k FROM (
          SELECT m.row_id, c.k, sum((m.x - c.x) ** 2) AS far FROM fm m JOIN c{i} c USING (pos) GROUP BY 1, 2) GROUP BY 1)"""

    def moved(i: int) -> str:
        return f"c{i + 1} AS MATERIALIZED (SELECT l.k, m.pos, avg(m.x) AS x FROM fm m JOIN l{i} l USING (row_id) GROUP BY 1, 2)"

    moves = ",\n".join(f"{nearest(i)},\n{moved(i)}" for i in range(SEGMENT_STEPS))
    return MATRIX + f""", started AS (SELECT row_id, dense_rank() OVER (ORDER BY coalesce(category, -1)) - 1 AS k FROM inventory),
      c0 AS MATERIALIZED (SELECT s.k, m.pos, avg(m.x) AS x FROM fm m JOIN started s USING (row_id) GROUP BY 1, 2),
      {moves}, {nearest(SEGMENT_STEPS)},
      segmented AS (SELECT i.*, l.k AS cluster_label FROM inventory i JOIN l{SEGMENT_STEPS} l USING (row_id))"""


SEGMENTED = _segmented_sql()


def segmented(spark: SparkSession, d: str) -> DataFrame:
    """Inventory with the label of a K-Means model on its feature matrix; labels are stored and read back."""
    stock = cut(inventory(spark, d))
    matrix, names = FT.feature_matrix(stock, FT.MAX_FEATURES, carry=["category"])
    matrix = cut(matrix)
    rows = K.Rows(matrix, "features")
    means = [F.avg(F.element_at("features", i + 1)).alias(f"m{i}") for i in range(len(names))]
    started = matrix.groupBy(F.coalesce("category", F.lit(-1)).alias("k")).agg(*means)
    starts = np.array([list(r)[1:] for r in started.orderBy("k").collect()])  # a row for each category
    fits = K.lloyd(rows, [starts], SEGMENT_STEPS, 0.0)
    path = scratch_path(spark, "labels")
    T.write_matrix(K.nearest_labels(rows, fits, with_features=False).select("row_id", F.col("labels")[0].alias("cluster_label")), path)
    return E.segment(stock, T.read_matrix(spark, path))


@query(
    "segmented_inventory",
    with_views(
        "inventory",
        f"{SEGMENTED} SELECT row_id, product_id, event_type, CAST(category AS BIGINT) AS category, nutriscore, CAST(cluster_label AS BIGINT) AS cluster_label FROM segmented",
    ),
)
def segmented_inventory(spark, d):
    return big(segmented(spark, d).select("row_id", "product_id", "event_type", "category", "nutriscore", "cluster_label"))


@query(
    "cluster_event_distribution",
    with_views("inventory", f"{SEGMENTED} SELECT CAST(cluster_label AS BIGINT) AS cluster_label, event_type, count(*) AS n FROM segmented GROUP BY 1, 2"),
)
def cluster_event_distribution(spark, d):
    return E.event_distribution(segmented(spark, d))


def _top(col: str, expr: str) -> str:
    return f"""{col}_top AS (SELECT cluster_label, arg_min(v, (-n, v)) AS v FROM (SELECT cluster_label, {expr} AS v, count(*) AS n
        FROM segmented WHERE {expr} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "cluster_profile",
    with_views(
        "inventory",
        f"""{SEGMENTED}, {_top('h', 'hour(timestamp)')}, {_top('c', 'category')}, {_top('k', 'classification')},
          s AS (SELECT cluster_label, count(*) AS n_rows, {', '.join(f'round(avg({c}), 6) AS mean_{c}' for c in schemas.NUTRIENTS)}
            FROM segmented WHERE cluster_label IS NOT NULL GROUP BY 1)
          SELECT s.*, CAST(h_top.v AS BIGINT) AS top_hour, CAST(c_top.v AS BIGINT) AS top_category, k_top.v AS top_classification
          FROM s JOIN h_top USING (cluster_label) JOIN c_top USING (cluster_label) JOIN k_top USING (cluster_label)""",
    ),
)
def cluster_profile(spark, d):
    profile = E.cluster_profile(cut(segmented(spark, d)))
    return rounded(big(profile), 6, *[f"mean_{c}" for c in schemas.NUTRIENTS])


RESULT_COLS = ["paradigm", "trial_no", "params", "silhouette", "metric", "n_clusters", "noise_ratio", "distance", "winner"]


@query("model_selection")
def model_selection(spark, d):
    """Phase 1 end to end: three sweeps, gates, comparison."""
    choice = P.choose_model(B.vectors(spark, d), 1)
    return rounded(big(choice.comparison.select(*RESULT_COLS)), 6, "silhouette", "metric", "noise_ratio")


@query("model_selection_refined")
def model_selection_refined(spark, d):
    """Phase 2 end to end, down to the rows per label of the winner."""
    choice = P.choose_model(B.vectors(spark, d), 2)
    winner = choice.comparison.filter("winner").first()
    rows = choice.labels.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("n_rows"))
    return big(rows.withColumns({"paradigm": F.lit(winner["paradigm"]), "params": F.lit(winner["params"])}))

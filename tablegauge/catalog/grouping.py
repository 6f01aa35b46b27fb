"""Clustering, its scores and the choice between methods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.catalog import query, rounded
from tablegauge.operators import clustering, density, metrics
from tablegauge.plans import clusters
from tablegauge.sources import load_table


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.points_from_array(load_table(spark, folder, "embeddings"), "vec_id", "embedding")


def scaled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.scale_points(vectors(spark, folder))


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer with all numeric columns but the key."""
    rows = load_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return clustering.points_from_columns(rows, "c_custkey")


def raw_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Every supplier with all numeric columns but the key."""
    rows = load_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return clustering.points_from_columns(rows, "s_suppkey")


def raw_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Every part with all numeric columns but the key."""
    rows = load_table(spark, folder, "part")
    numeric = [f.name for f in rows.schema if isinstance(f.dataType, T.NumericType) and f.name != "p_partkey"]
    return clustering.points_from_columns(rows.select("p_partkey", *numeric), "p_partkey")


def labelled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors with the given labels."""
    rows = load_table(spark, folder, "embeddings")
    x = F.col("embedding").cast("array<double>").alias("x")
    return clustering.one_labeling(rows.select(F.col("vec_id").alias("id"), x, "label"))


_V = "(SELECT vec_id AS id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings)"


@query(
    "j5_silhouette",
    f"""WITH d AS (SELECT a.id, a.label AS own, b.label AS other,
         sum(list_distance(a.x, b.x)) AS total, count(*) AS n FROM {_V} a, {_V} b GROUP BY 1, 2, 3),
      s AS (SELECT id, max(CASE WHEN own = other THEN n END) AS mates,
         max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
         min(CASE WHEN own <> other THEN total / n END) AS b FROM d GROUP BY id)
    SELECT round(avg(CASE WHEN mates = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""",
)
def silhouette(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clustering.silhouettes(labelled_vectors(spark, folder)).drop("variant"))


_SPREAD = f"""u AS (SELECT id, label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM {_V}),
  c AS (SELECT label, i, avg(v) AS m FROM u GROUP BY 1, 2),
  g AS (SELECT i, avg(v) AS m FROM u GROUP BY 1),
  r AS (SELECT u.id, u.label, sum((u.v - c.m) ** 2) AS sq FROM u JOIN c ON u.label = c.label AND u.i = c.i GROUP BY 1, 2),
  p AS (SELECT label, count(*) AS n, avg(sqrt(sq)) AS spread, sum(sq) AS within FROM r GROUP BY 1)"""


@query(
    "j6_davies_bouldin",
    f"""WITH {_SPREAD}, gap AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.m - b.m) ** 2)) AS d
        FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2),
      w AS (SELECT la, max((pa.spread + pb.spread) / d) AS ratio FROM gap JOIN p pa ON la = pa.label
            JOIN p pb ON lb = pb.label GROUP BY la)
    SELECT round(avg(ratio), 6) AS davies_bouldin FROM w""",
)
def davies_bouldin(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clustering.davies_bouldin(labelled_vectors(spark, folder)).drop("variant"))


@query(
    "j7_calinski_harabasz",
    f"""WITH {_SPREAD}, b AS (SELECT c.label, sum((c.m - g.m) ** 2) AS sq FROM c JOIN g ON c.i = g.i GROUP BY 1)
    SELECT round(sum(p.n * b.sq) * (sum(p.n) - count(*)) / (sum(p.within) * (count(*) - 1)), 6) AS calinski_harabasz
      FROM p JOIN b ON p.label = b.label""",
)
def calinski_harabasz(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clustering.calinski_harabasz(labelled_vectors(spark, folder)).drop("variant"))


@query("j9_noise_share", "SELECT round(avg(CASE WHEN label = 3 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS noise_ratio FROM embeddings")
def noise_share(spark: SparkSession, folder: str) -> DataFrame:
    marked = load_table(spark, folder, "embeddings").withColumn(
        "label", F.when(F.col("label") == 3, -1).otherwise(F.col("label"))
    )
    return rounded(clustering.noise_share(marked))


@query(
    "j11_adjusted_rand",
    """WITH t AS (SELECT label AS a, vec_id % 7 AS b, count(*) AS n FROM embeddings GROUP BY 1, 2),
      s AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM t) AS both_,
        (SELECT sum(k * (k - 1) / 2.0) FROM (SELECT sum(n) AS k FROM t GROUP BY a)) AS ra,
        (SELECT sum(k * (k - 1) / 2.0) FROM (SELECT sum(n) AS k FROM t GROUP BY b)) AS rb,
        (SELECT sum(n) * (sum(n) - 1) / 2.0 FROM t) AS pairs)
    SELECT round((both_ - ra * rb / pairs) / ((ra + rb) / 2 - ra * rb / pairs), 6)::DOUBLE AS adjusted_rand FROM s""",
)
def adjusted_rand(spark: SparkSession, folder: str) -> DataFrame:
    rows = load_table(spark, folder, "embeddings").select("label", (F.col("vec_id") % 7).alias("other"))
    return rounded(metrics.adjusted_rand(rows, "label", "other"))


@query(
    "c5_scale_vectors",
    """WITH u AS (SELECT vec_id AS id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)
    SELECT id, CAST(i - 1 AS INTEGER) AS i, round((v - avg(v) OVER (PARTITION BY i)) / stddev_pop(v) OVER (PARTITION BY i), 6) AS v
      FROM u""",
)
def scale_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scaled_vectors(spark, folder).select("id", F.posexplode("x").alias("i", "v")))


@query("j1_kmeans_sizes")
def kmeans_sizes(spark: SparkSession, folder: str) -> DataFrame:
    labels = clustering.kmeans(scaled_vectors(spark, folder), 10, n_init=10, parallelism=8)
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("j2_d8_t5_choose_k")
def choose_k(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clustering.choose_k(scaled_vectors(spark, folder), range(2, 11), n_init=10, parallelism=8))


def _xy(table: str, key: str, x: str, y: str) -> str:
    return f"""(SELECT {key} AS id, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y
  FROM (SELECT {key}, {x}::DOUBLE AS x, {y}::DOUBLE AS y FROM {table}))"""


_CUSTOMERS = _xy("customer", "c_custkey", "c_nationkey", "c_acctbal")
_SUPPLIERS = _xy("supplier", "s_suppkey", "s_nationkey", "s_acctbal")


# Distances of scaled vectors lie close together; these radii part them.
VECTOR_RADIUS = 9.25
VECTOR_RADII = (8.75, 9.0, 9.25, 9.5)

_SCALED_VECTORS = """(SELECT id, list(v ORDER BY i) AS x FROM (
  SELECT id, i, (v - avg(v) OVER (PARTITION BY i)) / stddev_pop(v) OVER (PARTITION BY i) AS v FROM (
    SELECT vec_id AS id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)) GROUP BY id)"""


def _dbscan_sql(
    eps: float, min_samples: int, points: str = _CUSTOMERS, squared: str = "(a.x - b.x) ** 2 + (a.y - b.y) ** 2"
) -> str:
    return f"""WITH RECURSIVE pt AS MATERIALIZED (SELECT * FROM {points}),
      near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM pt a, pt b
        WHERE {squared} <= {eps} * {eps}),
      core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {min_samples}),
      edge AS MATERIALIZED (SELECT n.a, n.b FROM near n JOIN core p ON n.a = p.id JOIN core q ON n.b = q.id),
      reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
      root AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
      num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM root)),
      own AS MATERIALIZED (SELECT id, cluster FROM root JOIN num USING (root)),
      edge_pt AS (SELECT n.a AS id, min(o.cluster) AS cluster FROM near n JOIN own o ON n.b = o.id GROUP BY n.a)
    SELECT pt.id, CAST(coalesce(own.cluster, edge_pt.cluster, -1) AS INTEGER) AS label
      FROM pt LEFT JOIN own ON pt.id = own.id LEFT JOIN edge_pt ON pt.id = edge_pt.id"""


@query("j3_dbscan", _dbscan_sql(0.15, 5))
def dbscan(spark: SparkSession, folder: str) -> DataFrame:
    return density.dbscan(clustering.scale_points(raw_customers(spark, folder)), 0.15, 5)


@query("j3_dbscan_embeddings", _dbscan_sql(VECTOR_RADIUS, 5, _SCALED_VECTORS, "list_distance(a.x, b.x) ** 2"))
def dbscan_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """All 64 coordinates of every vector."""
    return density.dbscan(scaled_vectors(spark, folder), VECTOR_RADIUS, 5)


def _sweep_sql(points: str = _SUPPLIERS) -> str:
    """All settings of the sweep: labels by spreading the smallest core id, then the scores."""
    eps = ", ".join(f"({i}, {e}::DOUBLE)" for i, e in enumerate(density.EPS_RANGE))
    least = ", ".join(f"({j}, {m})" for j, m in enumerate(density.MIN_SAMPLES_RANGE))
    return f"""WITH RECURSIVE pt AS MATERIALIZED (SELECT * FROM {points}),
      st AS MATERIALIZED (SELECT CAST(i * {len(density.MIN_SAMPLES_RANGE)} + j AS INTEGER) AS setting, eps, min_samples
        FROM (VALUES {eps}) a(i, eps), (VALUES {least}) b(j, min_samples)),
      pair AS MATERIALIZED (SELECT a.id AS a, b.id AS b, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS d2 FROM pt a, pt b),
      near AS MATERIALIZED (SELECT setting, a, b FROM pair, st WHERE d2 <= eps * eps),
      core AS MATERIALIZED (SELECT setting, a AS id FROM near JOIN st USING (setting)
        GROUP BY setting, a, min_samples HAVING count(*) >= min_samples),
      edge AS MATERIALIZED (SELECT n.setting, n.a, n.b FROM near n JOIN core p ON n.setting = p.setting AND n.a = p.id
        JOIN core q ON n.setting = q.setting AND n.b = q.id),
      root(setting, id, root) USING KEY (setting, id) AS (SELECT setting, id, id FROM core UNION
        SELECT e.setting, e.b, min(r.root) FROM root r JOIN edge e ON r.setting = e.setting AND r.id = e.a
          JOIN recurring.root c ON c.setting = e.setting AND c.id = e.b WHERE r.root < c.root GROUP BY e.setting, e.b),
      own AS MATERIALIZED (SELECT setting, id, dense_rank() OVER (PARTITION BY setting ORDER BY root) - 1 AS label FROM root),
      rim AS (SELECT n.setting, n.a AS id, min(o.label) AS label FROM near n JOIN own o ON n.setting = o.setting AND n.b = o.id
        GROUP BY 1, 2),
      lab AS MATERIALIZED (SELECT st.setting, pt.id, coalesce(own.label, rim.label, -1) AS label FROM st CROSS JOIN pt
        LEFT JOIN own ON own.setting = st.setting AND own.id = pt.id
        LEFT JOIN rim ON rim.setting = st.setting AND rim.id = pt.id),
      shape AS MATERIALIZED (SELECT setting, count(DISTINCT label) AS n_labels,
        avg(CASE WHEN label = -1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS noise_ratio FROM lab GROUP BY 1),
      kept AS MATERIALIZED (SELECT lab.* FROM lab JOIN shape USING (setting) WHERE label <> -1 AND n_labels > 2),
      gap AS (SELECT p.setting, p.id, p.label AS own, q.label AS other, sum(sqrt(d2)) AS total, count(*) AS n
        FROM kept p JOIN kept q ON p.setting = q.setting JOIN pair ON a = p.id AND b = q.id GROUP BY 1, 2, 3, 4),
      one AS (SELECT setting, id, max(CASE WHEN own = other THEN n END) AS mates,
        max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
        min(CASE WHEN own <> other THEN total / n END) AS b FROM gap GROUP BY 1, 2),
      sil AS (SELECT setting, avg(CASE WHEN mates = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS s
        FROM one GROUP BY 1),
      cen AS MATERIALIZED (SELECT setting, label, count(*) AS n, avg(x) AS cx, avg(y) AS cy
        FROM kept JOIN pt USING (id) GROUP BY 1, 2),
      mid AS (SELECT setting, avg(x) AS mx, avg(y) AS my FROM kept JOIN pt USING (id) GROUP BY 1),
      spr AS MATERIALIZED (SELECT k.setting, k.label, avg(sqrt((x - cx) ** 2 + (y - cy) ** 2)) AS spread,
        sum((x - cx) ** 2 + (y - cy) ** 2) AS within
        FROM kept k JOIN pt USING (id) JOIN cen c ON c.setting = k.setting AND c.label = k.label GROUP BY 1, 2),
      worst AS (SELECT p.setting, p.label, max((sp.spread + sq.spread) / sqrt((p.cx - q.cx) ** 2 + (p.cy - q.cy) ** 2)) AS r
        FROM cen p JOIN cen q ON p.setting = q.setting AND p.label <> q.label
        JOIN spr sp ON sp.setting = p.setting AND sp.label = p.label
        JOIN spr sq ON sq.setting = q.setting AND sq.label = q.label GROUP BY 1, 2),
      db AS (SELECT setting, avg(r) AS v FROM worst GROUP BY 1),
      ch AS (SELECT c.setting, sum(c.n * ((cx - mx) ** 2 + (cy - my) ** 2)) * (sum(c.n) - count(*))
          / (sum(within) * (count(*) - 1)) AS v
        FROM cen c JOIN mid USING (setting) JOIN spr s ON s.setting = c.setting AND s.label = c.label GROUP BY 1)
    SELECT st.setting, eps, min_samples, n_labels, round(noise_ratio, 6) AS noise_ratio, round(s, 6) AS silhouette,
      round(db.v, 6) AS davies_bouldin, round(ch.v, 4) AS calinski_harabasz,
      coalesce(st.setting = (SELECT setting FROM sil WHERE s > -1 ORDER BY s DESC, setting LIMIT 1), false) AS is_best
    FROM st JOIN shape USING (setting) LEFT JOIN sil USING (setting) LEFT JOIN db ON db.setting = st.setting
      LEFT JOIN ch ON ch.setting = st.setting"""


@query("j4_j9_dbscan_sweep", _sweep_sql())
def dbscan_sweep(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = density.dbscan_sweep(clustering.scale_points(raw_suppliers(spark, folder)))
    return rounded(table, calinski_harabasz=4)


@query("j8_d9_pca_points")
def pca(spark: SparkSession, folder: str) -> DataFrame:
    points = scaled_vectors(spark, folder)
    labels = load_table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return rounded(clustering.pca_points(points).join(labels, "id"))


@query("j12_seed_stability")
def stability(spark: SparkSession, folder: str) -> DataFrame:
    per_seed = clustering.seed_stability(scaled_vectors(spark, folder), 3, n_init=10, parallelism=8)
    return rounded(clustering.stability_summary(per_seed))


@query("j10_j13_cluster_choice")
def choice(spark: SparkSession, folder: str) -> DataFrame:
    """Metric rows of both methods over the full ranges, with the chosen one."""
    result = clusters.evaluate(raw_suppliers(spark, folder), "supplier", parallelism=8)
    return rounded(result.metrics.join(result.config, "dataset"))


@query("j4_j9_dbscan_sweep_embeddings")
def dbscan_sweep_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """A sweep over radii of the vectors' own range, on all coordinates."""
    table, _ = density.dbscan_sweep(scaled_vectors(spark, folder), VECTOR_RADII)
    return rounded(table, calinski_harabasz=4)


@query("j4_j9_dbscan_sweep_customers", _sweep_sql(_CUSTOMERS))
def dbscan_sweep_customers(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = density.dbscan_sweep(clustering.scale_points(raw_customers(spark, folder)))
    return rounded(table, calinski_harabasz=4)


@query("j4_j9_dbscan_sweep_parts")
def dbscan_sweep_parts(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = density.dbscan_sweep(clustering.scale_points(raw_parts(spark, folder)))
    return rounded(table, calinski_harabasz=4)


def _choice(points: DataFrame, dataset: str) -> DataFrame:
    result = clusters.evaluate(points, dataset, parallelism=8)
    return rounded(result.metrics.join(result.config, "dataset"))


@query("j10_j13_cluster_choice_customers")
def choice_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _choice(raw_customers(spark, folder), "customer")


@query("j10_j13_cluster_choice_parts")
def choice_parts(spark: SparkSession, folder: str) -> DataFrame:
    return _choice(raw_parts(spark, folder), "part")

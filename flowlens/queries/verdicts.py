"""Clustering, labelling and scoring operators, models and similarities."""

from pyspark.sql import functions as F

from flowlens.operators import aggregates as agg
from flowlens.operators import baselines, clustering, groups, indexing, itemsets, joins, models, ports
from flowlens.operators.scaling import Weights, min_max_scale, scale_zero_max
from flowlens.operators.similarity import item_similarity, user_similarity
from flowlens.plans import jobs
from flowlens.queries.parts import SEVEN, part
from flowlens.queries.registry import query
from flowlens.queries.relational import split_flows, _two_models
from flowlens.session import stored
from flowlens.sources import fixtures as fx

# -- clustering --------------------------------------------------------------------------------------------------------


def _asset_vectors(spark, d):
    scored = jobs.scored_assets(fx.flows_wide(spark, d))
    return clustering.assemble(scored, [f + "_scl" for f in SEVEN]).cache()


@query("kmeans_fit")
def kmeans_fit(spark, d):
    vectors = _asset_vectors(spark, d)
    return clustering.assign(clustering.kmeans_fit(vectors, 10), vectors).select("ip", "label", F.round("distance", 6).alias("distance"))


@query("kmeans_elbow_k")
def kmeans_elbow_k(spark, d):
    vectors = _asset_vectors(spark, d)
    k = clustering.elbow_k(vectors)
    members = clustering.assign(clustering.kmeans_fit(vectors, k), vectors)
    return agg.cluster_sizes(members).withColumn("k", F.lit(k))


@query("silhouette_k")
def silhouette_k(spark, d):
    return clustering.silhouette_by_k(_asset_vectors(spark, d), [2, 3, 4])


part("point_cells", "SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM points", "points")
part("point_centers", "SELECT label, i, avg(x) AS c FROM point_cells GROUP BY label, i", "point_cells")
part("point_distances", """
SELECT vec_id, p.label, sqrt(sum((x - c) * (x - c))) AS distance FROM point_cells p
JOIN point_centers c ON c.label = p.label AND c.i = p.i GROUP BY vec_id, p.label""", "point_cells", "point_centers")


def _point_distances(spark, d):
    """Labelled points with the distance to the mean of their label."""
    points = fx.embedding_points(spark, d)
    joined = joins.with_centers(points, clustering.vector_centers(points))
    return joined.select("vec_id", "label", clustering.array_distance(F.col("v"), F.col("center")).alias("distance"))


@query("distance_to_center", "SELECT vec_id, label, round(distance, 6) AS distance FROM point_distances", "point_distances")
def distance_to_center(spark, d):
    return _point_distances(spark, d).withColumn("distance", F.round("distance", 6))


part("split_points", "SELECT vec_id, CASE WHEN vec_id = 0 THEN 99 ELSE label END AS label, distance FROM point_distances", "point_distances")


@query("mark_outlier_clusters", """
SELECT vec_id, CASE WHEN n < 2 THEN '-1' ELSE CAST(label AS VARCHAR) END AS label, CASE WHEN n < 2 THEN -1 ELSE round(distance, 6) END AS distance
FROM (SELECT *, count(*) OVER (PARTITION BY label) AS n FROM split_points)""", "split_points")
def mark_outlier_clusters(spark, d):
    points = _point_distances(spark, d).withColumn("label", F.when(F.col("vec_id") == 0, 99).otherwise(F.col("label")))
    out = clustering.mark_small_clusters(points, 2, "-1", drop_distance=True)
    return out.withColumn("distance", F.round("distance", 6))


@query("quadrant_labels", "SELECT ip, label, round(proto, 6) AS proto, round(flow, 6) AS flow FROM labelled", "labelled")
def quadrant_labels(spark, d):
    out = groups.quadrant_labels(jobs.scored_assets(fx.flows_wide(spark, d)))
    return out.select("ip", "label", F.round("proto", 6).alias("proto"), F.round("flow", 6).alias("flow"))


@query("ensemble_outlier_score", """
SELECT vec_id, n AS num, round(pow(CASE WHEN hi = low THEN 0.5 ELSE (distance - low) / (hi - low) END, 2)
     + pow(1 - CASE WHEN n_hi = n_lo THEN 0.5 ELSE CAST(n - n_lo AS DOUBLE) / (n_hi - n_lo) END, 2), 6) AS unusual
FROM (SELECT *, CASE WHEN k = 1 THEN lo ELSE 0 END AS low, max(n) OVER () AS n_hi, min(n) OVER () AS n_lo
  FROM (SELECT *, count(*) OVER (PARTITION BY label) AS n, max(distance) OVER (PARTITION BY label) AS hi,
               min(distance) OVER (PARTITION BY label) AS lo, (SELECT count(DISTINCT label) FROM split_points) AS k FROM split_points))""", "split_points")
def ensemble_outlier_score(spark, d):
    points = _point_distances(spark, d).withColumn("label", F.when(F.col("vec_id") == 0, 99).otherwise(F.col("label")))
    return clustering.outlier_score(points).select("vec_id", "num", F.round("unusual", 6).alias("unusual"))


_HL_FLOW = ("packernum", "bytesize")


@query("cluster_high_low_label", f"""
SELECT p.ip, p.cluster AS label, coalesce(a.add_label, p.cluster) AS add_label FROM hl_points p LEFT JOIN (
  SELECT c.cluster, concat(CASE WHEN {' + '.join(f'0.25::DOUBLE * CASE WHEN t.{f} = 0 THEN 0 ELSE c.{f} / t.{f} END' for f in SEVEN[:4])} > t.mp THEN 'high' ELSE 'low' END, '#',
         CASE WHEN {' + '.join(f'0.33::DOUBLE * CASE WHEN t.{f} = 0 THEN 0 ELSE c.{f} / t.{f} END' for f in _HL_FLOW)} > t.mf THEN 'high' ELSE 'low' END) AS add_label
  FROM (SELECT cluster, {', '.join(f'avg({f}) AS {f}' for f in SEVEN)} FROM hl_points GROUP BY cluster) c,
       (SELECT {', '.join(f'max({f}) AS {f}' for f in SEVEN)}, avg(proto) AS mp, avg(flow) AS mf FROM hl_points) t
  WHERE c.cluster <> 'other') a ON a.cluster = p.cluster""", "hl_points")
def cluster_high_low_label(spark, d):
    labelled = groups.quadrant_labels(jobs.scored_assets(fx.flows_wide(spark, d)))
    points = labelled.withColumn("label", F.when(F.col("label").isin(*groups.OUTLIER_LABELS), "other").otherwise(F.col("label")))
    w = Weights()
    flow = tuple(x for x in w.flow if x[0] in _HL_FLOW)
    out = groups.high_low_labels(points, agg.cluster_centers(points, SEVEN), w.proto, flow)
    return out.select("ip", "label", "add_label")


@query("cluster_under_upper_label", """
SELECT label, concat(CASE WHEN avg(proto) > (SELECT p FROM bounds) THEN 'upper' ELSE 'under' END, '_',
       CASE WHEN avg(flow) > (SELECT f FROM bounds) THEN 'upper' ELSE 'under' END) AS add_feature FROM labelled GROUP BY label""", ("labelled", "bounds"))
def cluster_under_upper_label(spark, d):
    scored = jobs.scored_assets(fx.flows_wide(spark, d))
    bounds = scored.agg(F.avg("proto").alias("proto"), F.avg("flow").alias("flow"))
    return groups.under_upper_labels(groups.quadrant_labels(scored), bounds)


@query("center_distance_quadrant", "SELECT ip, label, center, round(distance, 6) AS distance FROM grouped", "grouped")
def center_distance_quadrant(spark, d):
    labelled = groups.quadrant_labels(jobs.scored_assets(fx.flows_wide(spark, d)))
    out = groups.center_distances(labelled, SEVEN)
    return out.select("ip", "label", "center", F.round("distance", 6).alias("distance"))


def _portrait_flows(spark, d):
    from flowlens.functions.flows import FLOW_PROTOCOLS, one_hot

    return fx.flows(spark, d).withColumns(one_hot(F.col("proto"), FLOW_PROTOCOLS))


@query("two_level_clustering")
def two_level_clustering(spark, d):
    one = jobs.portrait_level_one(_portrait_flows(spark, d))
    two = jobs.portrait_level_two(one, fx.moniflow(spark, d))
    return two.select("id", "ip", "parent", "label", "n_flows", F.round("distance", 6).alias("distance"))


@query("host_sparse_vectors", """
SELECT ip, host, round("count" / (SELECT max("count") FROM ratings), 6) AS v, count(*) OVER (PARTITION BY ip) AS filled,
       (SELECT count(DISTINCT host) FROM ratings) AS length FROM ratings""", "ratings")
def host_sparse_vectors(spark, d):
    cells = indexing.host_cells(scale_zero_max(fx.ratings(spark, d), "count", "scaled"), "scaled")
    return cells.withColumn("v", F.round("v", 6))


# -- port and flow verdicts --------------------------------------------------------------------------------------------

_PORT_COLUMNS = ["name", "row", "srcip", "dstip", "proto", "port", "abport", "index", "packernum"]
_PORT_SQL = ", ".join(f'"{c}"' for c in _PORT_COLUMNS)


@query("port_classify", f"SELECT {_PORT_SQL} FROM classified", "classified")
def port_classify(spark, d):
    return ports.classify_ports(fx.port_flows(spark, d)).select(_PORT_COLUMNS)


@query("port_classify_simple", f"SELECT {_PORT_SQL} FROM classified_simple", "classified_simple")
def port_classify_simple(spark, d):
    return ports.classify_ports_simple(fx.port_flows(spark, d)).select(_PORT_COLUMNS)


@query("judge_abnormal_port", 'SELECT name, "row", port, abport, "index", packernum FROM judged', "judged")
def judge_abnormal_port(spark, d):
    rows = ports.classify_ports(fx.port_flows(spark, d))
    out = ports.judge_ports(rows, ports.port_baseline_3mean(rows))
    return out.select("name", "row", "port", "abport", "index", "packernum")


JUDGED_FLOWS = """
SELECT f."row", f.srcip, f.proto, f.hour, f.packernum, CASE WHEN w.connectup IS NULL THEN 'protoabnormal'
       WHEN f.bytesize / 1024.0 > w.netflowup THEN 'netflowabnormal' WHEN f.packernum > w.connectup THEN 'connectabnormal' ELSE 'normal' END AS "index"
FROM current_flows f LEFT JOIN history_week w ON w.baseline = 'proto' AND w.name = f.srcip AND w.proto = f.proto AND w.hour = f.hour"""


@query("judge_abnormal_flow", JUDGED_FLOWS, ("current_flows", "history_week"))
def judge_abnormal_flow(spark, d):
    day, week = split_flows(spark, d)
    out = baselines.judge_flows(day, baselines.week_baseline(week))
    return out.select("row", "srcip", "proto", "hour", "packernum", "index")


# -- models ------------------------------------------------------------------------------------------------------------


@query("rf_train")
def rf_train(spark, d):
    """Hold-out accuracy of the flow classifier."""
    train, test = models.hold_out(fx.labelled_flows(spark, d), "recordid")
    model = models.forest_fit(train)
    typed = test.withColumns({f: F.col(f).cast("double") for f in models.FLOW_FEATURES})
    scored = model.transform(typed.withColumn("attacktype", F.col("attacktype").cast("double")))
    return agg.accuracy(scored, "attacktype", "prediction")


@query("rf_predict")
def rf_predict(spark, d):
    rows = fx.labelled_flows(spark, d)
    out = models.forest_predict(models.forest_fit(models.hold_out(rows, "recordid")[0]), rows)
    return out.select("recordid", "attacktype", "prediction")


@query("random_split")
def random_split(spark, d):
    train, test = models.hold_out(fx.flows(spark, d).select("row", "srcip"))
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query("url_train")
def url_train(spark, d):
    train, test = models.hold_out(fx.labelled_urls(spark, d), "doc_id")
    model = models.url_fit(train)
    return agg.confusion_counts(models.url_score(model, test))


@query("url_predict")
def url_predict(spark, d):
    """Attacks among all documents, by models trained on the labelled ones."""
    model = models.url_fit(fx.labelled_urls(spark, d))
    return models.url_attacks(model, fx.url_texts(spark, d)).drop("urltext")


def _indexed(spark, d):
    return indexing.index_users_items(stored(fx.ratings(spark, d), "ratings")).cache()


@query("als_implicit")
def als_implicit(spark, d):
    return jobs.behaviour_recommendations(fx.moniflow(spark, d))


@query("als_explicit")
def als_explicit(spark, d):
    indexed = _indexed(spark, d)
    model = models.als_fit(indexed, False, models.AlsParams(rank=50, reg=0.1))
    return model.transform(indexed).select("ip", "host", "count", "prediction")


@query("als_grid_search")
def als_grid_search(spark, d):
    return models.als_grid(_indexed(spark, d), [8, 16], [0.01, 0.1], [0.49])


@query("rating_metrics")
def rating_metrics(spark, d):
    indexed = _indexed(spark, d)
    return models.rating_errors(models.als_fit(indexed, False), indexed)


@query("topk_recommend_one")
def topk_recommend_one(spark, d):
    """Recommendations for one address, the busiest one."""
    indexed = _indexed(spark, d)
    model = models.als_fit(indexed)
    user = indexed.groupBy("ip_index", "ip").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "ip").limit(1)
    return models.top_items(model, 10, user.select("ip_index")).join(user.select("ip_index", "ip"), "ip_index").select("ip", "host_index", "score")


@query("topk_recommend")
def topk_recommend(spark, d):
    indexed = _indexed(spark, d)
    top = models.top_items(models.als_fit(indexed), 10)
    return top.join(indexed.select("ip_index", "ip").distinct(), "ip_index").select("ip", "host_index", "score")


@query("index_users_items")
def index_users_items(spark, d):
    return indexing.index_users_items(stored(fx.ratings(spark, d), "ratings"))


# -- similarity and rules ----------------------------------------------------------------------------------------------

part("host_norms", 'SELECT host, sqrt(sum("count" * "count")) AS n FROM ratings GROUP BY host', "ratings")


@query("item_cosine_similarity", """
SELECT host1, host2, round(sim, 6) AS sim FROM (
  SELECT a.host AS host1, b.host AS host2, sum(a."count" * b."count") / (any_value(na.n) * any_value(nb.n)) AS sim
  FROM ratings a JOIN ratings b ON a.ip = b.ip AND a.host < b.host JOIN host_norms na ON na.host = a.host JOIN host_norms nb ON nb.host = b.host
  GROUP BY a.host, b.host) WHERE sim >= 0.7 - 1e-12""", ("ratings", "host_norms"))
def item_cosine_similarity(spark, d):
    out = item_similarity(fx.ratings(spark, d))
    return out.select(F.col("left").alias("host1"), F.col("right").alias("host2"), F.round("sim", 6).alias("sim"))


@query("user_cosine_similarity", "SELECT ip1, ip2, sim FROM user_pairs", "user_pairs")
def user_cosine_similarity(spark, d):
    return user_similarity(fx.ratings(spark, d)).withColumnsRenamed({"left": "ip1", "right": "ip2"})


part("hour_visits", "SELECT DISTINCT ip, hour, host FROM visits", "visits")
part("hours", "SELECT ip, CAST(ceil(count(DISTINCT hour) * 0.5::DOUBLE) AS BIGINT) AS need FROM hour_visits GROUP BY ip", "hour_visits")
part("sets1", """
SELECT v.ip, host, count(*) AS freq, any_value(need) AS need FROM hour_visits v JOIN hours h ON h.ip = v.ip
GROUP BY v.ip, host HAVING count(*) >= any_value(need)""", "hour_visits", "hours")
part("kept_visits", "SELECT v.*, s.need FROM hour_visits v JOIN sets1 s ON s.ip = v.ip AND s.host = v.host", "hour_visits", "sets1")
part("sets2", """
SELECT a.ip, a.host AS x, b.host AS y, count(*) AS freq FROM kept_visits a JOIN kept_visits b ON a.ip = b.ip AND a.hour = b.hour AND a.host < b.host
GROUP BY a.ip, a.host, b.host HAVING count(*) >= any_value(a.need)""", "kept_visits")
part("sets3", """
SELECT a.ip, a.host AS x, b.host AS y, c.host AS z, count(*) AS freq FROM kept_visits a
JOIN sets2 s ON s.ip = a.ip AND s.x = a.host
JOIN kept_visits b ON a.ip = b.ip AND a.hour = b.hour AND b.host = s.y
JOIN sets2 t ON t.ip = b.ip AND t.x = b.host
JOIN kept_visits c ON a.ip = c.ip AND a.hour = c.hour AND c.host = t.y
GROUP BY a.ip, a.host, b.host, c.host HAVING count(*) >= any_value(a.need)""", "kept_visits", "sets2")
part("itemsets", """
SELECT ip, [host] AS items, 1 AS size, freq FROM sets1 UNION ALL SELECT ip, [x, y], 2, freq FROM sets2
UNION ALL SELECT ip, [x, y, z], 3, freq FROM sets3""", "sets1", "sets2", "sets3")


@query("frequent_itemsets", "SELECT ip, array_to_string(items, '#') AS items, size, freq FROM itemsets", "itemsets")
def frequent_itemsets(spark, d):
    """Report of the frequent sets of up to three hosts, spelled out; ``closed_itemsets`` has sets of any size."""
    out = itemsets.frequent_itemsets(jobs.visits(fx.moniflow(spark, d)), max_size=3)
    return out.withColumn("items", F.array_join("items", "#"))


SMALL_RULES = """
SELECT s.ip, array_to_string(b.items, '#') AS rule, r.c AS recommend, b.freq AS support, round(CAST(s.freq AS DOUBLE) / b.freq, 6) AS confidence
FROM itemsets s, LATERAL (SELECT unnest(s.items) AS c) r
JOIN itemsets b ON b.ip = s.ip AND b.items = list_filter(s.items, lambda x: x <> r.c)
WHERE s.size > 1 AND CAST(s.freq AS DOUBLE) / b.freq >= 0.6"""


@query("association_rules", SMALL_RULES, "itemsets")
def association_rules(spark, d):
    """Rules within sets of up to three hosts; ``closed_rules`` has rules of any size."""
    sets = itemsets.frequent_itemsets(jobs.visits(fx.moniflow(spark, d)), max_size=3)
    return itemsets.association_rules(sets).withColumn("confidence", F.round("confidence", 6))


part("masks", """
SELECT v.ip, v.host, v.mask, h.need FROM (SELECT ip, host, bit_or(1 << CAST(hour AS INT)) AS mask FROM hour_visits GROUP BY ip, host) v
JOIN hours h ON h.ip = v.ip WHERE bit_count(v.mask) >= h.need""", "hour_visits", "hours")
CLOSED = """
closed(ip, need, mask) AS (SELECT DISTINCT ip, need, mask FROM masks UNION
  SELECT c.ip, c.need, c.mask & m.mask FROM closed c JOIN (SELECT DISTINCT ip, mask FROM masks) m ON m.ip = c.ip WHERE bit_count(c.mask & m.mask) >= c.need)"""
part("closed", "WITH RECURSIVE" + CLOSED + " SELECT * FROM closed", "masks")
part("set_hosts", "SELECT c.ip, c.mask, m.host, m.mask AS own FROM closed c JOIN masks m ON m.ip = c.ip AND m.mask & c.mask = c.mask", "closed", "masks")


@query("closed_itemsets", "SELECT ip, mask, bit_count(mask) AS freq, host FROM set_hosts", "set_hosts")
def closed_itemsets(spark, d):
    """Closed frequent sets of any size, one row per set and host."""
    masks = itemsets.basket_masks(jobs.visits(fx.moniflow(spark, d)))
    return itemsets.set_members(itemsets.closed_sets(masks), masks).drop("own")


RULES = """
SELECT c.ip, c.mask AS rule, m.host AS recommend, bit_count(c.mask) AS support, round(CAST(bit_count(c.mask & m.mask) AS DOUBLE) / bit_count(c.mask), 6) AS confidence
FROM closed c JOIN masks m ON m.ip = c.ip
WHERE m.mask & c.mask <> c.mask AND bit_count(c.mask & m.mask) >= c.need AND CAST(bit_count(c.mask & m.mask) AS DOUBLE) / bit_count(c.mask) >= 0.6
UNION ALL
SELECT s.ip, s.mask, s.host, bit_count(s.mask), 1.0 FROM set_hosts s
WHERE (SELECT bit_and(o.own) FROM set_hosts o WHERE o.ip = s.ip AND o.mask = s.mask AND o.host <> s.host) = s.mask"""


@query("closed_rules", RULES, ("closed", "masks", "set_hosts"))
def closed_rules(spark, d):
    masks = itemsets.basket_masks(jobs.visits(fx.moniflow(spark, d)))
    return itemsets.closed_rules(itemsets.closed_sets(masks), masks).withColumn("confidence", F.round("confidence", 6))


@query("multiclass_metrics", """
SELECT round(sum(hit) / sum(actual), 6) AS accuracy, round(sum(p * actual) / sum(actual), 6) AS weighted_precision,
       round(sum(r * actual) / sum(actual), 6) AS weighted_recall, round(sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * actual) / sum(actual), 6) AS f1
FROM (SELECT c, actual, hit, CASE WHEN predicted = 0 THEN 0 ELSE CAST(hit AS DOUBLE) / predicted END AS p,
             CASE WHEN actual = 0 THEN 0 ELSE CAST(hit AS DOUBLE) / actual END AS r
      FROM (SELECT c, count(*) FILTER (label = c) AS actual, count(*) FILTER (prediction_nb = c) AS predicted,
                   count(*) FILTER (label = c AND prediction_nb = c) AS hit
            FROM two_models, (VALUES (0), (1)) t(c) GROUP BY c))""", "two_models")
def multiclass_metrics(spark, d):
    out = agg.multiclass_metrics(_two_models(spark, d), "label", "prediction_nb")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])

"""Similarities, item sets, clusters and models: brute force, library cross-checks and invariants."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.fpm import FPGrowth
from pyspark.mllib.linalg.distributed import CoordinateMatrix, MatrixEntry
from pyspark.sql import functions as F

from flowlens.operators import clustering, indexing, itemsets, models, top_products
from flowlens.operators import similarity as sim
from flowlens.plans import jobs
from flowlens.queries import verdicts
from flowlens.sources import fixtures as fx


@pytest.fixture(scope="module")
def ratings(spark, sf_dir):
    return fx.ratings(spark, sf_dir).cache()


def brute_cosine(entries):
    vecs = {}
    for m, k, v in entries:
        vecs.setdefault(m, {})[k] = v
    norm = {m: math.sqrt(sum(x * x for x in d.values())) for m, d in vecs.items()}
    out = {}
    for a, b in itertools.combinations(sorted(vecs), 2):
        dot = sum(x * vecs[b].get(k, 0.0) for k, x in vecs[a].items())
        if set(vecs[a]) & set(vecs[b]):
            out[(a, b)] = dot / (norm[a] * norm[b])
    return out


@pytest.mark.parametrize("threshold", [0.2, 0.7, 0.95])
def test_pairs_above_threshold_are_complete(spark, threshold):
    rnd = random.Random(7)
    entries = [
        (f"h{h:02d}", f"u{u:02d}", float(rnd.randrange(1, 6)))
        for h in range(40) for u in range(25) if rnd.random() < (0.95 if u == 0 else 0.12)
    ]
    df = spark.createDataFrame(entries, "host string, ip string, count double")
    want = {p: s for p, s in brute_cosine(entries).items() if s >= threshold}
    got = {(r.left, r.right): r.sim for r in sim.cosine_pairs_above(df, "host", "ip", "count", threshold).collect()}
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p]) for p in want)


def test_all_pairs_equal_column_similarities(spark, ratings):
    indexed = indexing.index_users_items(ratings).cache()
    cells = indexed.select("ip_index", "host_index", "count").rdd.map(lambda r: MatrixEntry(r[0], r[1], r[2]))
    theirs = {(e.i, e.j): e.value for e in CoordinateMatrix(cells).toRowMatrix().columnSimilarities().entries.collect()}
    number = {r.host: r.host_index for r in indexed.select("host", "host_index").distinct().collect()}
    ours = {}
    for r in sim.cosine_pairs(ratings, "host", "ip", "count").collect():
        i, j = sorted((number[r.left], number[r.right]))
        ours[(i, j)] = r.sim
    assert ours.keys() == theirs.keys()
    assert all(ours[k] == pytest.approx(theirs[k]) for k in ours)


def test_dense_index(spark, ratings):
    idx = sorted(r.n for r in indexing.dense_index(ratings, "host", "n").collect())
    assert idx == list(range(len(idx))) and len(idx) == ratings.select("host").distinct().count()


def test_itemsets_equal_fpgrowth(spark, sf_dir):
    visits = jobs.visits(fx.moniflow(spark, sf_dir)).cache()
    support = 0.2
    ours = itemsets.frequent_itemsets(visits, support, max_size=None).cache()
    for ip in sorted(r.ip for r in visits.select("ip").distinct().collect())[:3]:
        one = visits.where(F.col("ip") == ip).groupBy("hour").agg(F.collect_set("host").alias("items"))
        model = FPGrowth(minSupport=support, minConfidence=0.6).fit(one)
        want = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect()}
        got = {tuple(r["items"]): r.freq for r in ours.where(F.col("ip") == ip).collect()}
        assert got == want
        rules = {("#".join(sorted(r.antecedent)), r.consequent[0]): r.confidence for r in model.associationRules.collect()}
        mine = {(r.rule, r.recommend): r.confidence for r in itemsets.association_rules(ours.where(F.col("ip") == ip), 0.6).collect()}
        assert mine == pytest.approx(rules)


def test_larger_itemsets(spark):
    rows = [("a", f"h{i}", h) for h in range(4) for i in range(5)] + [("a", "rare", 0), ("b", "h0", 3)]
    df = spark.createDataFrame(rows, "ip string, host string, hour int")
    got = itemsets.frequent_itemsets(df, 0.9, max_size=None).where("ip = 'a'")
    assert {r["size"]: r.n for r in got.groupBy("size").agg(F.count("*").alias("n")).collect()} == {1: 5, 2: 10, 3: 10, 4: 5, 5: 1}
    capped = itemsets.frequent_itemsets(df, 0.9, max_size=2).where("ip = 'a'")
    assert capped.count() == 15


def test_guarded_k():
    assert [clustering.guarded_k(n, 7) for n in (1, 2, 3, 7, 8, 100)] == [1, 1, 2, 6, 7, 7]


def test_outlier_score_cases(spark):
    one = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 3.0), ("c", 0, 2.0)], "id string, label int, distance double")
    got = {r.id: r.unusual for r in clustering.outlier_score(one).collect()}
    assert got == pytest.approx({"a": 0.25, "b": 1.25, "c": 0.5})  # one cluster: distance from its minimum, size 0.5
    two = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0), ("c", 1, 0.0)], "id string, label int, distance double")
    got = {r.id: r.unusual for r in clustering.outlier_score(two).collect()}
    assert got == pytest.approx({"a": 0.25, "b": 1.0, "c": 0.25 + 1.0})  # a lone member scales to 0.5, the smallest cluster to 0


def test_small_clusters(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 1.0), ("c", 1, 9.0)], "id string, label int, distance double")
    out = {r.id: (r.label, r.distance) for r in clustering.mark_small_clusters(df, 2, "-1", drop_distance=True).collect()}
    assert out == {"a": ("0", 1.0), "b": ("0", 1.0), "c": ("-1", -1.0)}


def test_grouped_kmeans_separates_each_group(spark):
    rnd = random.Random(11)
    rows, n = [], 0
    for g, shift in (("a", 0.0), ("b", 100.0)):
        for center in (0.0, 10.0, 20.0):
            for _ in range(30):
                rows.append((g, n, shift + center + rnd.random(), center + rnd.random(), int(center)))
                n += 1
    rows += [("tiny", n, 1.0, 1.0, 0), ("tiny", n + 1, 1.0, 1.0, 0)]
    df = spark.createDataFrame(rows, "g string, id int, x double, y double, truth int")
    out = clustering.grouped_kmeans(df, ["g"], "id", ["x", "y"], 3).cache()
    assert out.count() == len(rows)
    pairs = {(r.g, r.truth, r.label) for r in out.where("g <> 'tiny'").select("g", "truth", "label").distinct().collect()}
    assert len(pairs) == 6 and len({(g, l) for g, _, l in pairs}) == 6
    assert {r.label for r in out.where("g = 'tiny'").collect()} == {0}
    assert out.agg(F.max("distance")).first()[0] < 2


def test_weighted_grouped_kmeans_equals_repeated_rows(spark):
    rows = [("g", 1, 0.0, 3), ("g", 2, 1.0, 1), ("g", 3, 10.0, 2), ("g", 4, 11.0, 2)]
    df = spark.createDataFrame(rows, "g string, id int, x double, w int")
    folded = clustering.grouped_kmeans(df, ["g"], "id", ["x"], 2, weight="w")
    repeated = clustering.grouped_kmeans(df.withColumn("w", F.explode(F.sequence(F.lit(1), "w"))), ["g"], "id", ["x"], 2)
    a = {r.id: (r.label, round(r.distance, 6)) for r in folded.collect()}
    b = {r.id: (r.label, round(r.distance, 6)) for r in repeated.collect()}
    assert a == b and a[1][1] == 0.25


def test_scaled_grouped_kmeans_equals_scaling_first(spark, monkeypatch):
    """Scaling, choice of groups and cluster sizes inside the clustering give what separate steps give, hot groups included."""
    from flowlens.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    rnd, rows = random.Random(5), []
    for g, n in (("hot", 90), ("warm", 12), ("one", 1), ("other", 70), ("cold", 5), (None, 3)):
        rows += [(g, f"{g}{i:03d}", rnd.choice([1, 2, 50, 900]), rnd.random() if i else None, 7) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id string, x int, y double, same int")
    kept = spark.createDataFrame([("hot",), ("warm",), ("one",)], "g string")
    names = ["x", "y", "same"]
    first = clustering.grouped_min_max(df.join(kept, "g", "left_semi"), ["g"], "id", names)
    want = clustering.grouped_kmeans(first, ["g"], "id", [f"{n}_scl" for n in names], 3)
    got = clustering.grouped_kmeans(df, ["g"], "id", names, 3, scaled=True, only=kept)
    shown = ["g", "id", *names, "label", "cluster_size"]
    text = lambda d: sorted(str((*(r[c] for c in shown), r.distance is None or round(r.distance, 9))) for r in d.collect())
    assert text(got) == text(want) and got.count() == 103
    sizes = {(r.g, r.label): r["count"] for r in got.groupBy("g", "label").count().collect()}
    assert all(sizes[(r.g, r.label)] == r.cluster_size for r in got.collect())


def test_forest_walks_its_trees_once_a_row(spark):
    """No filter repeats the prediction, and the votes are not made; the rows are those of the plain model."""
    rows = spark.createDataFrame([(str(i % 3), float(i), i % 2, 1 - i % 2, i, 5 * i) for i in range(60)] + [("1", None, 1, 0, 1, 1)],
                                 "attacktype string, spandtime double, tcp int, udp int, packernum int, bytesize int")
    model = models.forest_fit(rows)
    out = models.forest_predict(model, rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any("Filter" in line and "UDF" in line for line in plan.splitlines())
    typed = rows.withColumns({f: F.col(f).cast("double") for f in models.FLOW_FEATURES}).dropna()
    want = model.transform(typed).where("prediction > 0").select(out.columns)
    assert out.columns == [*rows.columns, "prediction"] and out.dtypes == want.dtypes
    assert sorted(out.collect()) == sorted(want.collect()) and out.count() > 0


def test_clusters_cover_all_rows(spark, sf_dir):
    out = verdicts.kmeans_fit(spark, sf_dir).collect()
    assert len({r.ip for r in out}) == len(out) and all(r.distance >= 0 for r in out)
    members = jobs.netflow_clusters(fx.flows_wide(spark, sf_dir)).collect()
    assert len({r.ip for r in members}) == len(members)
    assert all(r.label == "other" or set(r.add_label.split("#")) <= {"high", "low"} for r in members)


def test_flow_outliers(spark, sf_dir):
    out = jobs.flow_outliers(fx.flows(spark, sf_dir), k=4).collect()
    scores = [r.unusuals for r in out]
    assert scores == sorted(scores, reverse=True) and min(scores) >= 0
    assert len(out) == fx.flows(spark, sf_dir).select("recordtime", "srcip", "dstip", "proto").distinct().count()


def test_model_labels_gather_no_points(spark):
    """Rows meet the few rows of their model's labels where they are: nothing sorts or shuffles them by label."""
    rows = spark.range(0, 400, 1, 8).selectExpr("cast(id AS string) AS id", "cast(id % 4 AS double) * 100 AS x", "cast(id AS double) AS y", "1.0D AS z")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        model = clustering.triple_model(rows, ["x", "y", "z"], ["id"], 4)
        out = clustering.triple_scores(rows, ["x", "y", "z"], model, "1")
        assert out.count() == 400
        assert out.withColumn("p", F.spark_partition_id()).select("p").distinct().count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_elbow(spark):
    rows = [(float(c * 100 + i),) for c in range(3) for i in range(10)]
    vectors = clustering.assemble(spark.createDataFrame(rows, "x double"), ["x"]).cache()
    assert 2 <= clustering.elbow_k(vectors, largest=6) <= 6


def test_host_clusters(spark, sf_dir):
    out = jobs.host_clusters(fx.moniflow(spark, sf_dir)).collect()
    assert all(len(r.top_hosts.split("#")) <= 10 for r in out)
    assert all((r.label == "-1") == (r.distance == -1) for r in out)


def test_forest_round_trip(spark, sf_dir, tmp_path):
    rows = fx.labelled_flows(spark, sf_dir)
    model = models.forest_fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    from flowlens.sources.readers import load_model

    a = models.forest_predict(model, rows).groupBy("recordid").agg(F.max("prediction")).collect()
    b = models.forest_predict(load_model(str(tmp_path / "m")), rows).groupBy("recordid").agg(F.max("prediction")).collect()
    assert sorted(a) == sorted(b) and all(r[1] > 0 for r in a)


def test_flow_attacks_with_a_model(spark, sf_dir):
    model = models.forest_fit(fx.labelled_flows(spark, sf_dir))
    out = jobs.flow_attacks(fx.flows(spark, sf_dir), model)
    assert out.where("attacktype = '' or flownums <= 10").isEmpty()


def test_url_models(spark):
    rows = [(0.0, f"/ x ? q = select {i} union") for i in range(30)] + [(1.0, f"/ home ? page = {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "label double, urltext string")
    model = models.url_fit(df, models.TextParams(max_iter=10))
    scored = models.url_score(model, df).collect()
    assert all(0.5 <= r.probability_nb <= 1 and 0.5 <= r.probability_lr <= 1 for r in scored)
    assert models.url_attacks(model, df).count() == 30


def test_recommendations(spark, sf_dir, ratings):
    out = jobs.behaviour_recommendations(fx.moniflow(spark, sf_dir), models.AlsParams(rank=5, iterations=2)).cache()
    per_user = out.groupBy("ip", "time").count()
    assert per_user.agg(F.max("count")).first()[0] <= 10
    assert max(float(r.scores) for r in out.collect()) == 1.0
    users = {r.ip for r in jobs.behaviour_ratings(fx.moniflow(spark, sf_dir))[1].collect()}
    assert {r.ip for r in out.collect()} <= users
    indexed = indexing.index_users_items(ratings).cache()
    model = models.als_fit(indexed, True, models.AlsParams(rank=5, iterations=2))
    one = models.top_items(model, 3, indexed.select("ip_index").limit(1))
    assert one.count() == 3
    err = models.rating_errors(model, indexed).first()
    assert err.rmse == pytest.approx(err.mse**0.5)


def test_hold_out_is_stable(spark, sf_dir):
    flows = fx.flows(spark, sf_dir).select("row")
    a, b = models.hold_out(flows, "row")
    assert a.count() + b.count() == flows.count()
    again = models.hold_out(flows.repartition(3), "row")[0]
    assert sorted(r.row for r in a.collect()) == sorted(r.row for r in again.collect())


def test_two_level_portrait(spark, sf_dir):
    flows = verdicts._portrait_flows(spark, sf_dir)
    out = jobs.asset_portrait(flows, fx.moniflow(spark, sf_dir)).collect()
    first = [r for r in out if r.type == "1"]
    second = [r for r in out if r.type == "2"]
    assert first and second and all(r.label in {"0", "1", "2"} for r in out)
    assert {(r.ip, r.parent) for r in second} <= {(r.ip, r.label) for r in first}
    assert all(r.members > 2 for r in first)


def test_sparse_kmeans_equals_plain_rounds(spark):
    """Labels, distances and centers of the long form against the same rounds on dense rows."""
    from flowlens.operators.sparse import sparse_kmeans

    rnd = random.Random(12)
    rows = {f"m{i:02d}": {f"h{rnd.randrange(5) + 6 * (i % 3)}": rnd.random() + 1 for _ in range(4)} for i in range(24)}
    keys = sorted({h for r in rows.values() for h in r})
    dense = {m: [r.get(h, 0.0) for h in keys] for m, r in rows.items()}
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    centers = [dense["m00"]]
    while len(centers) < 3:
        centers.append(dense[max(dense, key=lambda m: (min(gap(dense[m], c) for c in centers), m))])
    before = None
    for _ in range(20):
        label = {m: min(range(3), key=lambda i: (gap(v, centers[i]), i)) for m, v in dense.items()}
        cost = sum(gap(dense[m], centers[i]) for m, i in label.items())
        if before is not None and before - cost <= 1e-6 * before:
            break
        before = cost
        centers = [[sum(dense[m][j] for m in dense if label[m] == i) / max(1, sum(x == i for x in label.values())) for j in range(len(keys))] for i in range(3)]
    entries = spark.createDataFrame([(m, h, v) for m, r in rows.items() for h, v in r.items()], "m string, h string, v double")
    got = {r.m: r for r in sparse_kmeans(entries, "m", "h", "v", 3).collect()}
    assert {m: r.label for m, r in got.items()} == label
    assert all(got[m].distance == pytest.approx(gap(dense[m], centers[label[m]]) ** 0.5, abs=1e-6) for m in dense)
    assert sparse_kmeans(entries.limit(0), "m", "h", "v", 3).count() == 0


def test_closed_sets_hold_every_frequent_set(spark, sf_dir):
    visits = jobs.visits(fx.moniflow(spark, "/root/testdata/sf0.01")).where("ip = '10.1.0.5'")
    masks = itemsets.basket_masks(visits).cache()
    closed = itemsets.closed_sets(masks)
    members = {}
    for r in itemsets.set_members(closed, masks).collect():
        members.setdefault(r.mask, set()).add(r.host)
    sets = itemsets.frequent_itemsets(visits, max_size=3).collect()
    own = {r.host: r.mask for r in masks.collect()}
    assert sets
    for s in sets:
        mask = own[s["items"][0]]
        for host in s["items"]:
            mask &= own[host]
        assert bin(mask).count("1") == s.freq and set(s["items"]) <= members[mask]
    rules = {(r.rule, r.recommend): r.confidence for r in itemsets.closed_rules(closed, masks).collect()}
    for r in itemsets.association_rules(spark.createDataFrame(sets)).collect():
        mask = -1
        for host in r.rule.split("#"):
            mask &= own[host]
        assert rules[(mask, r.recommend)] == pytest.approx(r.confidence)


def plain_closed(masks: list[int], need: int) -> set[int]:
    found: set[int] = set()
    for m in masks:
        found |= {m & other for other in found} | {m}
    return {m for m in found if m.bit_count() >= need}


@pytest.mark.parametrize("hours, n, need", [(24, 9, 3), (24, 14, 8), (10, 300, 2), (12, 4000, 5), (6, 40, 1), (24, 1, 0), (24, 0, 4)])
def test_closed_masks(hours, n, need):
    rnd = random.Random(n)
    masks = [rnd.getrandbits(hours) | rnd.getrandbits(hours) for _ in range(n)]
    got = itemsets.closed_masks(np.array(masks, "i4"), need).tolist()
    assert len(got) == len(set(got)) and set(got) == plain_closed([m for m in masks if m.bit_count() >= need], need)


def test_closed_masks_of_an_address_with_very_many_hosts():
    """10^5 masks of 24 hours: one pass over the lattice, whose result is closed under intersection and holds every mask."""
    rnd = np.random.default_rng(4)
    masks = np.unique(rnd.integers(0, 1 << 24, 260_000) | rnd.integers(0, 1 << 24, 260_000)).astype("i4")
    masks = masks[np.bitwise_count(masks) >= 17]
    assert len(masks) > 100_000
    got = itemsets.closed_masks(masks, 17)
    assert np.isin(masks, got).all() and np.bitwise_count(got).min() == 17
    pairs = masks[rnd.integers(0, len(masks), 50_000)] & masks[rnd.integers(0, len(masks), 50_000)]
    assert np.isin(pairs[np.bitwise_count(pairs) >= 17], got).all()
    some = got[:: len(got) // 200]
    for m in some.tolist():
        assert int(np.bitwise_and.reduce(masks[(masks & m) == m])) == m


def test_pairs_of_masks_in_many_blocks(spark, monkeypatch):
    rnd = random.Random(8)
    visits = [(f"10.0.0.{i}", f"h{h}", hour) for i in range(3) for h in range(60) for hour in range(24) if rnd.random() < 0.7] + [(None, "x", 1)]
    masks = itemsets.basket_masks(spark.createDataFrame(visits, "ip string, host string, hour int"), 0.7).cache()
    closed = itemsets.closed_sets(masks)
    want = {(r.ip, r.rule, r.recommend, r.support, r.confidence) for r in itemsets.closed_rules(closed, masks, 0.8).collect()}
    members = {(r.ip, r.mask, r.host) for r in itemsets.set_members(closed, masks).collect()}
    own = {}
    for r in masks.collect():
        own.setdefault(r.ip, {})[r.host] = r.mask
    assert {(r.ip, r.mask) for r in closed.collect()} == {(ip, m) for ip, of in own.items() for m in plain_closed(list(of.values()), 17)}
    assert members == {(ip, m, h) for ip, m in {x[:2] for x in members} for h, o in own[ip].items() if o & m == m}
    monkeypatch.setattr(itemsets, "BLOCK_MASKS", 16)
    monkeypatch.setattr(itemsets, "BATCH", 100)
    again = itemsets.closed_sets(masks)
    assert {(r.ip, r.rule, r.recommend, r.support, r.confidence) for r in itemsets.closed_rules(again, masks, 0.8).collect()} == want and want
    for ip, rule, host, support, confidence in want:
        if own[ip][host] & rule != rule:
            assert confidence == pytest.approx((own[ip][host] & rule).bit_count() / rule.bit_count()) and support == rule.bit_count()


@pytest.mark.parametrize("threshold", [0.4, 0.7, 0.9])
def test_similarity_where_most_members_share_a_key(spark, monkeypatch, threshold):
    """A host that 60 % of the addresses visit, weights of all sizes, blocks of a few rows: the plain product decides."""
    rnd = random.Random(12)
    entries = [(f"ip{i:03}", f"h{h:02}", rnd.choice([1.0, 2.0, 9.0, 40.0])) for i in range(150) for h in range(30)
               if rnd.random() < (0.6 if h == 0 else 0.4 if h < 3 else 0.06)]
    df = spark.createDataFrame(entries, "ip string, host string, count double")
    want = {p: s for p, s in brute_cosine([(a, b, c) for a, b, c in entries]).items() if s >= threshold}
    got = {(r.left, r.right): r.sim for r in sim.cosine_pairs_above(df, "ip", "host", "count", threshold).collect()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)


def blobs(spark, n=900, seed=3):
    rnd = np.random.default_rng(seed)
    at = np.array([[0, 0, 0], [10, 0, 0], [0, 10, 0], [0, 0, 10], [10, 10, 10]], float)
    x = at[rnd.integers(0, 5, n)] + rnd.normal(0, 0.6, (n, 3))
    return clustering.assemble(spark.createDataFrame(x.tolist(), "a double, b double, c double"), ["a", "b", "c"]).cache(), x


def test_sweep_is_kmeans_for_every_k(spark):
    """Moments belong to the centers, centers are the means of their rows, and k = 5 finds the five groups."""
    vectors, x = blobs(spark)
    ks = list(range(2, 9))
    for k, (centers, moments) in zip(ks, clustering.kmeans_sweep(vectors, ks, max_iter=40)):
        square = ((x[:, None] - centers) ** 2).sum(2)
        label = square.argmin(1)
        assert moments[:, 0].tolist() == np.bincount(label, minlength=k).tolist()
        assert moments[:, 1].sum() == pytest.approx(square.min(1).sum()) and moments[:, 2].sum() == pytest.approx((x * x).sum())
        for i in range(k):
            assert centers[i] == pytest.approx(x[label == i].mean(0), abs=1e-3)
        theirs = KMeans(k=k, featuresCol="vector", predictionCol="label", seed=1).fit(vectors).summary.trainingCost
        assert moments[:, 1].sum() <= 2.5 * theirs
        if k == 5:
            assert moments[:, 1].sum() == pytest.approx(theirs, rel=0.01)


def test_silhouette_of_all_k_equals_the_evaluator(spark):
    vectors, x = blobs(spark, 400)
    got = {r.k: r.silhouette for r in clustering.silhouette_by_k(vectors, [2, 3, 5, 7]).collect()}
    for k, (centers, _) in zip([2, 3, 5, 7], clustering.kmeans_sweep(vectors, [2, 3, 5, 7], max_iter=20)):
        label = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
        labelled = clustering.assemble(spark.createDataFrame([(*p, float(i)) for p, i in zip(x.tolist(), label.tolist())], "a double, b double, c double, label double"), ["a", "b", "c"])
        assert got[k] == pytest.approx(ClusteringEvaluator(featuresCol="vector", predictionCol="label").evaluate(labelled), abs=1e-9)
    assert max(got, key=got.get) == 5


def test_elbow_of_few_rows(spark):
    for rows in ([[1.0, 2.0, 3.0]], [[1.0, 2.0, 3.0]] * 5, [[float(i), 0.0, 0.0] for i in range(4)]):
        df = clustering.assemble(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
        assert 2 <= clustering.elbow_k(df) <= 20


@pytest.mark.parametrize("k, blocks", [(1, (7, 5)), (10, (64, 16)), (400, (50, 30))])
def test_top_products_stop_early_and_are_exact(spark, monkeypatch, k, blocks):
    """Lengths of all sizes, rows that repeat and rows of zeros; many blocks, so that users stop in different rounds."""
    monkeypatch.setattr(top_products, "USER_BLOCK", blocks[0])
    monkeypatch.setattr(top_products, "ITEM_BLOCK", blocks[1])
    rnd = np.random.default_rng(k)
    users = rnd.normal(0, 1, (90, 6)) * rnd.lognormal(0, 2, (90, 1))
    items = rnd.normal(0, 1, (300, 6)) * rnd.lognormal(0, 2, (300, 1))
    users[3], items[7], items[8] = 0, 0, items[9]
    frame = lambda x: spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id int, v array<double>")
    got = {}
    for r in top_products.top_inner_products(frame(users), frame(items), k).collect():
        got.setdefault(r.user, []).append((-r.score, r.item))
    score = users @ items.T
    for u in range(90):
        want = sorted((-s, i) for i, s in enumerate(score[u].tolist()))[:k]
        assert [i for _, i in sorted(got[u])] == [i for _, i in want] and [s for s, _ in sorted(got[u])] == pytest.approx([s for s, _ in want])
    assert top_products.top_inner_products(frame(users).limit(0), frame(items), k).count() == 0


def test_top_items_equal_the_library(spark, ratings):
    indexed = indexing.index_users_items(ratings).cache()
    model = models.als_fit(indexed, True, models.AlsParams(rank=5, iterations=2))
    ours, theirs = {}, {}
    for r in models.top_items(model, 4).collect():
        ours.setdefault(r.ip_index, []).append(r.score)
    for r in model.recommendForAllUsers(4).collect():
        theirs[r.ip_index] = sorted((x.rating for x in r.recommendations), reverse=True)
    assert ours.keys() == theirs.keys()
    for u in ours:
        assert sorted(ours[u], reverse=True) == pytest.approx(theirs[u], rel=1e-4, abs=1e-6)

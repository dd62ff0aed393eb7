"""Supervised models and recommendations on Spark ML pipelines."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import IDF, HashingTF, Tokenizer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.top_products import top_inner_products
from flowlens.session import for_many_passes, scratch_path, shared_folder, stored

SEED = 42
FLOW_FEATURES = ["spandtime", "tcp", "udp", "packernum", "bytesize"]
# Parts of the day, in order.
DAY_PARTS = ("morning", "noon", "afternoon", "night", "midnight")


@dataclass(frozen=True)
class ForestParams:
    # Default settings of the flow classifier.
    trees: int = 25
    impurity: str = "entropy"
    max_bins: int = 18
    max_depth: int = 8
    subsampling: float = 0.3
    subset: str = "2"


@dataclass(frozen=True)
class TextParams:
    # Default settings of the URL classifiers.
    features: int = 20000
    max_iter: int = 100
    reg: float = 0.05
    elastic_net: float = 0.01


@dataclass(frozen=True)
class AlsParams:
    # Default settings of the behaviour recommendation.
    rank: int = 300
    iterations: int = 10
    reg: float = 0.01
    alpha: float = 0.49
    top: int = 10


def hold_out(df: DataFrame, key: str | None = None, share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """70/30 split: random with a fixed seed, or by a hash of a key so that a row keeps its side between runs."""
    if key is None:
        train, test = df.randomSplit([share, 1 - share], seed=SEED)
        return train, test
    side = F.pmod(F.xxhash64(key), F.lit(10)) < int(share * 10)
    return df.where(side), df.where(~side)


def balanced_sample(labelled: DataFrame, live: DataFrame, order: str, factor: int = 1) -> DataFrame:
    """All labelled rows and up to ``factor`` times as many live rows, the first ones in the order of a key.

    The limit is part of the training recipe. The rows are numbered over all tasks, which hold a range of the key each, so
    no task gathers them.
    """
    n = labelled.count() * factor
    ordered = live.select(*labelled.columns, F.col(order).alias("__order")).orderBy("__order").withColumn("__task", F.spark_partition_id())
    ordered = stored(ordered, "ordered-sample")
    sizes = ordered.groupBy("__task").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    starts = sizes.select("__task", "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    whole = F.col("__start") + F.col("__n") <= n
    cut = starts.where((F.col("__start") < n) & ~whole).first()
    chosen = ordered.join(F.broadcast(starts.where(whole).select("__task")), "__task", "left_semi")
    if cut is not None:  # the rest of one range
        last = ordered.where(F.col("__task") == cut["__task"])
        place = F.row_number().over(Window.orderBy("__order"))
        chosen = chosen.unionByName(last.withColumn("__p", place).where(F.col("__p") <= n - cut["__start"]).drop("__p"))
    return labelled.unionByName(chosen.select(*labelled.columns))


def forest_pipeline(params: ForestParams = ForestParams()) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FLOW_FEATURES, outputCol="features"),
            VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=6, handleInvalid="keep"),
            RandomForestClassifier(
                labelCol="attacktype", featuresCol="indexed", numTrees=params.trees, impurity=params.impurity,
                maxBins=params.max_bins, maxDepth=params.max_depth, subsamplingRate=params.subsampling,
                featureSubsetStrategy=params.subset, seed=SEED,
            ),
        ]
    )


def fitted(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """The pipeline fitted on rows that are persisted for as long as it takes."""
    even = for_many_passes(rows)
    try:
        return pipeline.fit(even)
    finally:
        even.unpersist()


def forest_fit(sample: DataFrame, params: ForestParams = ForestParams()) -> PipelineModel:
    typed = sample.select(
        F.col("attacktype").try_cast("double").alias("attacktype"),
        *[F.col(f).try_cast("double").alias(f) for f in FLOW_FEATURES],
    )
    return fitted(forest_pipeline(params), typed.dropna())


def forest_predict(model: PipelineModel, flows: DataFrame) -> DataFrame:
    """Rows the model takes for an attack (class above 0).

    The trees are walked once a row: a filter on the prediction would be pushed below it and walk them again, one inside a
    generator is not. Votes and probabilities, which nobody reads, are not made.
    """
    typed = flows.withColumns({f: F.col(f).try_cast("double") for f in FLOW_FEATURES}).dropna(subset=FLOW_FEATURES)
    classes = model.copy()
    classes.stages[-1].setRawPredictionCol("").setProbabilityCol("").setPredictionCol("__class")
    scored = classes.transform(typed).select("*", F.explode(F.filter(F.array("__class"), lambda c: c > 0)).alias("prediction"))
    return scored.drop("features", "indexed", "__class")


def url_pipeline(params: TextParams = TextParams()) -> Pipeline:
    return Pipeline(
        stages=[
            Tokenizer(inputCol="urltext", outputCol="words"),
            HashingTF(inputCol="words", outputCol="counts", numFeatures=params.features),
            IDF(inputCol="counts", outputCol="features"),
            NaiveBayes(featuresCol="features", predictionCol="prediction_nb", probabilityCol="probability_nb",
                       rawPredictionCol="raw_nb"),
            LogisticRegression(
                maxIter=params.max_iter, regParam=params.reg, elasticNetParam=params.elastic_net, featuresCol="features",
                predictionCol="prediction_lr", probabilityCol="probability_lr", rawPredictionCol="raw_lr",
            ),
        ]
    )


def url_fit(labelled: DataFrame, params: TextParams = TextParams(), path: str | None = None) -> PipelineModel:
    """``labelled``: label (0 attack, 1 normal), urltext.

    The model is stored (below the shared folder, if no path is given) and comes back as it is read from there: what scores
    carries nothing of its training along to the executors.
    """
    rows = labelled.select(F.col("label").cast("double").alias("label"), "urltext")
    path = path or scratch_path(labelled.sparkSession, "url-model")
    fitted(url_pipeline(params), rows).write().overwrite().save(path)
    return PipelineModel.load(path)


def url_score(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Both predictions, each with the probability of its class."""
    scored = model.transform(texts)

    def chosen(m: str) -> F.Column:
        return F.get(vector_to_array(f"probability_{m}"), F.col(f"prediction_{m}").cast("int")).alias(f"probability_{m}")

    return scored.select(*texts.columns, "prediction_nb", chosen("nb"), "prediction_lr", chosen("lr"))


def url_attacks(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Rows the Bayes model takes for an attack (class 0)."""
    return url_score(model, texts).where("prediction_nb < 1")


def als(implicit: bool = True, params: AlsParams = AlsParams(), blocks: int = 10) -> ALS:
    return ALS(
        userCol="ip_index", itemCol="host_index", ratingCol="count", rank=params.rank, maxIter=params.iterations,
        regParam=params.reg, alpha=params.alpha, implicitPrefs=implicit, numUserBlocks=blocks,
        numItemBlocks=blocks, seed=SEED, coldStartStrategy="drop", checkpointInterval=5,
    )


def als_fit(indexed: DataFrame, implicit: bool = True, params: AlsParams = AlsParams()) -> ALSModel:
    sc = indexed.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(indexed.sparkSession))
    blocks = max(10, sc.defaultParallelism)
    return als(implicit, params, blocks).fit(indexed.select("ip_index", "host_index", "count"))


def top_items(model: ALSModel, k: int, users: DataFrame | None = None) -> DataFrame:
    """Top-k items per user as rows (ip_index, host_index, score), from the factors of the model."""
    own = model.userFactors if users is None else model.userFactors.join(users.select(F.col("ip_index").alias("id")).distinct(), "id", "left_semi")
    top = top_inner_products(own.withColumnRenamed("features", "v"), model.itemFactors.withColumnRenamed("features", "v"), k)
    return top.select(F.col("user").cast("int").alias("ip_index"), F.col("item").cast("int").alias("host_index"), F.col("score").cast("float").alias("score"))


def recommend_by_day_part(indexed: DataFrame, params: AlsParams = AlsParams()) -> DataFrame:
    """Top items per user and part of the day (ip_index, host_index, score, time), one model per part.

    The models do not depend on each other and are fitted side by side.
    """

    def one(part: str) -> DataFrame | None:
        rows = indexed.where(F.col("time") == part)
        if rows.isEmpty():
            return None
        return top_items(als_fit(rows, True, params), params.top).withColumn("time", F.lit(part))

    with ThreadPool(len(DAY_PARTS)) as pool:
        parts = [p for p in pool.map(one, DAY_PARTS) if p is not None]
    out = indexed.sparkSession.createDataFrame([], "ip_index int, host_index int, score float, time string")
    for p in parts:
        out = out.unionByName(p)
    return out


def rating_errors(model: ALSModel, indexed: DataFrame) -> DataFrame:
    """Mean squared error and its root of predicted against actual ratings."""
    scored = model.transform(indexed)
    gap = F.col("prediction") - F.col("count")
    return scored.agg(F.avg(gap * gap).alias("mse")).withColumn("rmse", F.sqrt("mse"))


def als_grid(indexed: DataFrame, ranks: list[int], regs: list[float], alphas: list[float], iterations: int = 10) -> DataFrame:
    """Training error of every parameter combination; one row each. A few models are fitted side by side."""
    data = indexed.select("ip_index", "host_index", "count").cache()
    judge = RegressionEvaluator(labelCol="count", predictionCol="prediction", metricName="mse")

    def one(rank: int, reg: float, alpha: float) -> tuple:
        model = als_fit(data, True, AlsParams(rank=rank, iterations=iterations, reg=reg, alpha=alpha))
        mse = float(judge.evaluate(model.transform(data)))
        return rank, reg, alpha, iterations, mse, mse**0.5

    with ThreadPool(4) as pool:
        rows = pool.starmap(one, product(ranks, regs, alphas))
    data.unpersist()
    return indexed.sparkSession.createDataFrame(
        rows, "rank int, reg double, alpha double, iterations int, mse double, rmse double"
    )

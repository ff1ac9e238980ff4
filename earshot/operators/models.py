"""Feature preparation, training and calibration with Spark ML."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earshot.constants import RECENCY_DECAY, SPLIT_SEED, STAGE2_COLS
from earshot.operators.metrics import classification_metrics
from earshot.operators.splits import stratified_folds
from earshot.session import ensure_checkpoint_dir, materialize, scratch_path

# Deepest tree Spark ML grows; stands for "no limit".
UNLIMITED_DEPTH = 30


def impute_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric columns as doubles with 0.0 for missing values, and was_imputed (0 / 1) per row."""
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in cols])
    filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in cols}
    return df.withColumn("was_imputed", gap.cast("int")).withColumns(filled)


def medians(df: DataFrame, cols: list[str], accuracy: int = 100_000) -> DataFrame:
    """One row of column medians over non-null values; relative rank error 1 / accuracy."""
    return df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in cols])


def exact_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Interpolated medians of columns with few distinct values, such as trailing rates and counts."""
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("x")).where("x.v IS NOT NULL").groupBy("x.name", "x.v").agg(F.count(F.lit(1)).alias("freq"))
    return values.groupBy("name").agg(F.percentile("v", 0.5, F.col("freq")).alias("median"))


def impute_median(train: DataFrame, rows: DataFrame, cols: list[str], zero_first: bool = False) -> DataFrame:
    """rows with train medians for missing values; zero_first fills zeros instead, as unseen rows once got."""
    if zero_first:
        return rows.fillna(0.0, subset=cols)
    fitted = medians(train, cols)
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), fitted.select(c).scalar()) for c in cols})


def recency_weight(df: DataFrame, year: str = "year", decay: float = RECENCY_DECAY) -> DataFrame:
    newest = df.agg(F.max(year)).scalar()
    return df.withColumn("weight", F.pow(F.lit(decay), newest - F.col(year)))


def balanced_weight(df: DataFrame, y: str = "mentioned") -> DataFrame:
    """df + weight = n / (2 * n_class)."""
    counts = df.agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    pos, neg = counts.select("pos").scalar(), counts.select("neg").scalar()
    return df.withColumn("weight", (pos + neg) / (2.0 * F.when(F.col(y) == 1, pos).otherwise(neg)))


def with_text_features(rows: DataFrame, contexts: DataFrame, size: int, numeric: list[str], out: str = "features") -> DataFrame:
    """rows + one sparse vector: the weights of contexts (ticker, cutoff, indices, values), then the numeric columns.

    A context holds at most `size` weights. The arrays are written as the fields of a vector and read back as vectors, so
    no weight passes through Python.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "contexts")
    sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values")
    contexts.select(F.col("ticker").alias("_ticker"), F.col("cutoff").alias("_cutoff"), sparse.alias("_text")).write.option("compression", "zstd").parquet(path)
    vectors = spark.read.schema(StructType().add("_ticker", "string").add("_cutoff", "date").add("_text", VectorUDT())).parquet(path)
    met = F.col("ticker").eqNullSafe(F.col("_ticker")) & F.col("cutoff").eqNullSafe(F.col("_cutoff"))
    joined = impute_zero(rows, numeric).join(vectors, met).drop("_ticker", "_cutoff")
    return VectorAssembler(inputCols=["_text", *numeric], outputCol=out).transform(joined).drop("_text")


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def positive_probability(model, df: DataFrame, out: str) -> DataFrame:
    """Batch scoring: df + probability of class 1."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def macro_f1(predictions: DataFrame, y: str, by: tuple[str, ...] = ()) -> float:
    scored = predictions.withColumn("pred", F.col("prediction").cast("int"))
    return classification_metrics(scored, y, by=by).agg(F.avg("f1_macro")).first()[0]


# Rows and vector elements per task while training: small tables should not pay for empty tasks at every iteration, and
# wide rows should not wait for one task.
ROWS_PER_TASK = 20_000
ELEMENTS_PER_TASK = 16_000_000


def _training_table(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows on shared storage, in as many partitions as their number and width ask for, and their number."""
    stored = materialize(df, "training")
    n = stored.count()
    width = stored.select("features").first()[0].size if n and "features" in df.columns else 1
    tasks, wide = max(1, -(-n // ROWS_PER_TASK)), -(-n * width // ELEMENTS_PER_TASK)
    return (stored.repartition(wide) if wide > tasks else stored.coalesce(tasks)).persist(), n


def _over_folds(fit_fold, n_folds: int, spark, parallelism: int) -> DataFrame:
    """Union of the held-out predictions of every fold; the fits share the cluster."""
    with ThreadPool(processes=min(parallelism, n_folds)) as pool:
        parts = pool.map(inheritable_thread_target(spark)(fit_fold), range(n_folds))
    return reduce(DataFrame.unionByName, parts)


def _logreg(c: float, total_weight: float, y: str) -> LogisticRegression:
    """Penalty 1/2 |w|^2 + C * weighted loss, rescaled to Spark's mean loss; the intercept is not penalised."""
    return LogisticRegression(
        labelCol=y, weightCol="weight", standardization=False, elasticNetParam=0.0, maxIter=1000, tol=1e-5,
        regParam=1.0 / (c * total_weight),
    )


def train_logreg(train: DataFrame, y: str = "mentioned", key: str = "market_ticker", n_folds: int = 5,
                 c_values: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0), seed: int = SPLIT_SEED, parallelism: int = 5):
    """(model, best C) by cross-validated macro F1 on the training rows only; class-balanced weights."""
    data, n = _training_table(stratified_folds(train, y, key, n_folds, seed))
    try:
        best = (None, -1.0)
        # Balanced weights sum to the number of rows.
        sizes = {row.fold: row["count"] for row in data.groupBy("fold").count().collect()}
        for c in c_values:
            def held_out(fold: int, c: float = c) -> DataFrame:
                part = balanced_weight(data.where(F.col("fold") != fold), y)
                model = _logreg(c, n - sizes.get(fold, 0), y).fit(part)
                return model.transform(data.where(F.col("fold") == fold)).select("fold", y, "prediction")

            score = macro_f1(_over_folds(held_out, n_folds, data.sparkSession, parallelism), y, ("fold",))
            if score > best[1]:
                best = (c, score)
        return _logreg(best[0], n, y).fit(balanced_weight(data, y)), best[0]
    finally:
        data.unpersist()


def train_tree(train: DataFrame, dev: DataFrame, y: str = "mentioned", depths=(3, 5, 10, 15, None),
               max_bins: int = 32, seed: int = SPLIT_SEED, parallelism: int = 5):
    """(model, best depth): balanced gini tree, depth by dev macro F1, the first best wins. The fits share the cluster."""
    data, _ = _training_table(balanced_weight(train, y))
    held_out = materialize(dev, "dev")
    # Trees look up every element of every row, which takes a search in a sparse vector.
    dense = data.withColumn("features", array_to_vector(vector_to_array("features")))

    def grown(depth: int | None):
        model = DecisionTreeClassifier(
            labelCol=y, weightCol="weight", impurity="gini", maxDepth=depth or UNLIMITED_DEPTH, maxBins=max_bins, seed=seed
        ).fit(dense)
        return model, depth, macro_f1(model.transform(held_out), y)

    try:
        with ThreadPool(processes=min(parallelism, len(depths))) as pool:
            fitted = pool.map(inheritable_thread_target(data.sparkSession)(grown), depths)
        model, depth, _ = max(fitted, key=lambda tree: tree[2])
        return model, depth
    finally:
        data.unpersist()


def train_boosting(train: DataFrame, features: list[str], y: str = "word_said", max_iter: int = 500,
                   seed: int = SPLIT_SEED) -> PipelineModel:
    """Stage 1: boosted trees with recency weights. Lineage is cut at shared checkpoints as trees add up."""
    ensure_checkpoint_dir(train.sparkSession)
    boosting = GBTClassifier(
        labelCol=y, weightCol="weight", maxIter=max_iter, maxDepth=7, stepSize=0.03, subsamplingRate=0.8,
        featureSubsetStrategy="0.8", minInstancesPerNode=20, checkpointInterval=10, seed=seed,
    )
    data, _ = _training_table(train)
    try:
        return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), boosting]).fit(data)
    finally:
        data.unpersist()


def with_candle(df: DataFrame, price: str = "daily_open_mid", fallback: str = "tx_prob") -> DataFrame:
    """Crowd price where there is a candle, else the text probability, and a flag telling which."""
    return df.withColumn("open_mid_filled", F.coalesce(price, fallback)).withColumn(
        "has_candle", F.col(price).isNotNull().cast("int")
    )


def fit_platt(rows: DataFrame, y: str, c: float, features: tuple[str, ...] = STAGE2_COLS,
              n: int | None = None) -> PipelineModel:
    n = rows.count() if n is None else n
    logistic = LogisticRegression(labelCol=y, standardization=False, regParam=1.0 / (c * n), maxIter=1000, tol=1e-8)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="stage2_features"),
                            logistic.setFeaturesCol("stage2_features")]).fit(rows)


def train_platt(rows: DataFrame, y: str = "market_yes", key: str = "market_ticker", n_folds: int = 5,
                c_values: tuple[float, ...] = (0.01, 0.03, 0.05, 0.1, 0.3, 0.5), seed: int = SPLIT_SEED,
                parallelism: int = 5):
    """(model, best C) by cross-validated Brier score; the first best wins."""
    data, n = _training_table(stratified_folds(rows, y, key, n_folds, seed))
    try:
        best = (None, float("inf"))
        sizes = {row.fold: row["count"] for row in data.groupBy("fold").count().collect()}
        for c in c_values:
            def held_out(fold: int, c: float = c) -> DataFrame:
                model = fit_platt(data.where(F.col("fold") != fold), y, c, n=n - sizes.get(fold, 0))
                return positive_probability(model, data.where(F.col("fold") == fold), "p").select("fold", y, "p")

            score = (
                _over_folds(held_out, n_folds, data.sparkSession, parallelism).groupBy("fold")
                .agg(F.avg(F.pow(F.col("p") - F.col(y), F.lit(2))).alias("brier")).agg(F.avg("brier")).first()[0]
            )
            if score < best[1]:
                best = (c, score)
        return fit_platt(data, y, best[0], n=n), best[0]
    finally:
        data.unpersist()


def coefficients(spark, names: list[str], model) -> DataFrame:
    rows = [*zip(names, [float(v) for v in model.coefficients]), ("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "feature STRING, coefficient DOUBLE")


def top_importances(spark, names: list[str], model, n: int = 10) -> DataFrame:
    rows = list(zip(names, [float(v) for v in model.featureImportances.toArray()]))
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(
        F.col("importance").desc(), "feature").limit(n)

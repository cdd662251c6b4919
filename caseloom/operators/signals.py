"""Outbreak signals: a gradient-boosted classifier, batch scoring, importance, a versioned registry."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import boosting
from caseloom.operators.features import FEATURE_COLUMNS, KEY_COLUMNS, LABEL_COLUMN
from caseloom.operators.metrics import ranking_metrics
from caseloom.session import shared_dir

#: Columns that may be unknown; Spark's trees take no missing values, so each gets an indicator and a value below all others.
NULLABLE = ["baseline_mean_28d", "baseline_sd_28d", "baseline_z", "lag_1_cases", "lag_7_cases", "delta_1_cases", "prior_mean_cases"]
BELOW_ALL = -1e6


def filled(df: DataFrame) -> DataFrame:
    missing = {f"{c}_missing": F.col(c).isNull().cast("double") for c in NULLABLE}
    return df.withColumns(missing).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(BELOW_ALL)) for c in NULLABLE})


def balanced(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """Adds ``weight``: both classes weigh the same in all."""
    n = df.agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
    up, down = n.n / (2.0 * max(n.p, 1)), n.n / (2.0 * max(n.n - n.p, 1))
    return df.withColumn("weight", F.when(F.col(label) == 1, up).otherwise(down))


def train(df: DataFrame, iterations: int = 300, seed: int = 42) -> PipelineModel:
    """Depth 4, step 0.06, at least 15 rows a leaf, balanced weights.

    Rows alike in every bin are counted and the trees grown on the counts in one task. Where those are too many for a task, Spark
    fits; then every tenth round's errors are checkpointed: the lineage of 300 rounds overflows the stack."""
    shared_dir(df.sparkSession)
    columns = [*FEATURE_COLUMNS, *[f"{c}_missing" for c in NULLABLE]]
    gbt = GBTClassifier(
        labelCol=LABEL_COLUMN, featuresCol="features", weightCol="weight", maxDepth=4, stepSize=0.06, maxIter=iterations, minInstancesPerNode=15, seed=seed,
        cacheNodeIds=True, checkpointInterval=10,
    )
    rows, assembler = balanced(filled(df)).select(*columns, LABEL_COLUMN, "weight"), VectorAssembler(inputCols=columns, outputCol="features")
    model = boosting.fit(gbt, rows, columns)
    return PipelineModel([assembler, model]) if model else Pipeline(stages=[assembler, gbt]).fit(rows)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``signal_score``, the probability of an outbreak day."""
    raw = {c: df.schema[c].dataType for c in NULLABLE}
    out = model.transform(filled(df)).withColumn("signal_score", vector_to_array("probability")[1])
    back = {c: F.when(F.col(f"{c}_missing") == 1.0, F.lit(None)).otherwise(F.col(c)).cast(t) for c, t in raw.items()}
    return out.withColumns(back).drop("features", "rawPrediction", "probability", "prediction", *[f"{c}_missing" for c in NULLABLE])


def signal_table(scored: DataFrame, threshold: float, version: str) -> DataFrame:
    """The published columns, best first; a threshold has to be given."""
    columns = [*KEY_COLUMNS, "condition_name", "county", "case_count", "baseline_mean_28d", "baseline_z", "signal_score", "is_signal", "threshold", "model_version", "scored_at"]
    return (
        scored.withColumns({
            "is_signal": (F.col("signal_score") >= threshold).cast("int"), "threshold": F.lit(float(threshold)), "model_version": F.lit(version), "scored_at": F.current_timestamp(),
        })
        .select(*columns)
        .orderBy(F.desc("signal_score"), *KEY_COLUMNS)
    )


#: Rows a bucket in which values change rows, and positive scores of all repeats together that the driver holds.
ROWS_A_BUCKET, SCORES_AT_ONCE = 20_000, 500_000


def permutation_importance(model: PipelineModel, df: DataFrame, columns: list[str] | None = None, repeats: int = 5, seed: int = 42) -> DataFrame:
    """feature, importance: mean loss of average precision when a column's values change rows.

    All columns and repeats are scored in two passes over rows dealt once; where the positive rows are too many for
    that, one column and repeat after the other."""
    spark, columns = df.sparkSession, columns or FEATURE_COLUMNS
    n = df.agg(F.count("*").alias("n"), F.count_if(F.col(LABEL_COLUMN) == 1).alias("p")).first()
    if not n.p or repeats < 1:
        lost = {c: 0.0 for c in columns}
    elif n.p * repeats * len(columns) > SCORES_AT_ONCE:
        lost = _one_by_one(model, df, columns, repeats, seed)
    else:
        inputs = model.stages[0].getInputCols()
        moved = [[k for k, x in enumerate(inputs) if x in (c, f"{c}_missing")] for c in columns]
        forest, buckets = boosting.Forest(model.stages[-1], len(inputs)), -(-n.n // ROWS_A_BUCKET)
        ap = boosting.average_precisions(forest, inputs, filled(df), KEY_COLUMNS, F.coalesce(F.col(LABEL_COLUMN) == 1, F.lit(False)), moved, repeats, seed, buckets)
        lost = {c: sum(ap[-1, 0] - ap[k, r] for r in range(repeats)) / repeats for k, c in enumerate(columns)}
    return spark.createDataFrame([(c, float(x)) for c, x in lost.items()], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _one_by_one(model: PipelineModel, df: DataFrame, columns: list[str], repeats: int, seed: int) -> dict[str, float]:
    precision = lambda x: ranking_metrics(score(model, x).withColumn("label", F.col(LABEL_COLUMN)), "signal_score").first().average_precision
    base = precision(df)
    return {c: sum(base - precision(shuffled(df, c, seed + r)) for r in range(repeats)) / repeats for c in columns}


def shuffled(df: DataFrame, column: str, seed: int, buckets: int = 64) -> DataFrame:
    """The table with one column's values moved to other rows, the same values overall.

    Rows are dealt into buckets by one hash; within a bucket the value of the row that is n-th by a
    second hash goes to the row that is n-th by the keys."""
    from pyspark.sql.window import Window

    key = F.xxhash64(*KEY_COLUMNS, F.lit(seed))
    keyed = df.withColumn("_b", F.pmod(key, F.lit(buckets)))
    mine = keyed.withColumn("_n", F.row_number().over(Window.partitionBy("_b").orderBy(*KEY_COLUMNS)))
    other = keyed.select("_b", F.row_number().over(Window.partitionBy("_b").orderBy(F.xxhash64(*KEY_COLUMNS, F.lit(seed + 1_000)))).alias("_n"), F.col(column).alias("_v"))
    return mine.join(other, ["_b", "_n"]).withColumn(column, F.col("_v")).drop("_b", "_n", "_v")


class Registry:
    """Model versions as directories 1, 2, ... below a path."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.root = spark, f"{path.rstrip('/')}/{name}"

    def versions(self) -> list[int]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(where) if f.getPath().getName().isdigit()) if fs.exists(where) else []

    def register(self, model: PipelineModel) -> int:
        version = max(self.versions(), default=0) + 1
        model.write().save(f"{self.root}/{version}")
        return version

    def latest(self) -> tuple[PipelineModel, int]:
        versions = self.versions()
        if not versions:
            raise LookupError(f"no model is registered below {self.root}")
        return PipelineModel.load(f"{self.root}/{versions[-1]}"), versions[-1]

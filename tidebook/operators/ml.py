"""Baseline classifiers over sampled features and labels."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions.scalar import number
from tidebook.operators import metrics
from tidebook.operators.audit import constant_columns
from tidebook.schemas import LEAKAGE


def feature_columns(df: DataFrame, wanted: list[str] | None = None, sample: int = 50_000) -> list[str]:
    """Columns that may be features: wanted ones that exist, without leakage and without constants in the sample."""
    names = [c for c in (wanted or df.columns) if c in df.columns and c not in LEAKAGE]
    flat = {r["column"] for r in constant_columns(df.limit(sample), names).filter("constant").collect()}  # one row a column
    return [c for c in names if c not in flat]


def matrix(df: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """df with numeric, null-free features and y: label -1, 0, 1 as class 0, 1, 2."""
    have = [number(c).alias(c) if c in df.columns else F.lit(0.0).alias(c) for c in columns]
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, *have).withColumn("y", (F.col(label) + 1).cast("double"))


def balanced(df: DataFrame) -> DataFrame:
    """df with w: weights that give every class the same sum."""
    n = df.groupBy("y").agg(F.count("*").alias("_c"))
    total, k = df.count(), n.count()
    return df.join(F.broadcast(n), "y").withColumn("w", F.lit(float(total)) / (F.lit(float(max(1, k))) * F.col("_c"))).drop("_c")  # n: one row a class


def models(columns: list[str], seed: int = 42, trees: int = 200, rounds: int = 30) -> dict[str, Pipeline]:
    """Untrained baselines by name."""
    vec = VectorAssembler(inputCols=columns, outputCol="raw", handleInvalid="keep")
    scaled = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    plain = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")
    return {
        "logistic": Pipeline(stages=[vec, scaled, LogisticRegression(labelCol="y", weightCol="w", family="multinomial", maxIter=50)]),
        "forest": Pipeline(stages=[plain, RandomForestClassifier(labelCol="y", weightCol="w", numTrees=trees, maxDepth=12, minInstancesPerNode=50, seed=seed)]),
        "boosted": Pipeline(stages=[plain, OneVsRest(classifier=GBTClassifier(maxIter=rounds, maxDepth=5, seed=seed), labelCol="y")]),
    }


def softmax(df: DataFrame, columns: list[str], coefficients, intercepts) -> DataFrame:
    """df with prob, the class probabilities of a multinomial model, and p, the first class of the largest."""
    z = F.array(*[sum((F.lit(c) * F.col(x) for c, x in zip(row, columns)), F.lit(b)) for row, b in zip(coefficients, intercepts)])
    top = F.array_max("_z")
    parts = F.transform("_z", lambda x: F.exp(x - top))
    out = df.withColumn("_z", z).withColumn("prob", parts)
    total = F.aggregate("prob", F.lit(0.0), lambda a, b: a + b)
    out = out.withColumn("prob", F.transform("prob", lambda x: x / total))
    return out.withColumn("p", (F.array_position("prob", F.array_max("prob")) - 1).cast("int")).drop("_z")


def predictions(model: PipelineModel, df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, y, p and the class probabilities as an array where the model gives them."""
    out = model.transform(df)
    prob = vector_to_array("probability").alias("prob") if "probability" in out.columns else F.lit(None).cast("array<double>").alias("prob")
    return out.select(*keys, F.col("y").cast("int").alias("y"), F.col("prediction").cast("int").alias("p"), prob)


def evaluate(predicted: DataFrame) -> dict[str, float]:
    """Metrics of a prediction table by name."""
    out = metrics.totals(predicted).first().asDict() | metrics.pt_score(predicted).first().asDict()
    if dict(predicted.dtypes)["prob"] != "void":
        out |= metrics.log_loss(predicted.filter("prob IS NOT NULL")).first().asDict()
    return out


def select(scores: dict[str, dict[str, float]]) -> str:
    """The model of least mean union-over-intersection on validation, the first by name on ties."""
    return min(sorted(scores), key=lambda name: scores[name]["pt_avg"])


def importance(spark: SparkSession, model: PipelineModel, columns: list[str], top: int = 50) -> DataFrame:
    """(rank, feature, importance) of the strongest features: tree importances or mean absolute coefficients."""
    last = model.stages[-1]
    if hasattr(last, "coefficientMatrix"):
        m = last.coefficientMatrix.toArray()
        values = abs(m).mean(axis=0)
    elif hasattr(last, "models"):
        values = sum(x.featureImportances.toArray() for x in last.models) / len(last.models)
    else:
        values = last.featureImportances.toArray()
    rows = sorted(zip(columns, map(float, values)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame([(i + 1, c, v) for i, (c, v) in enumerate(rows)], "rank int, feature string, importance double")

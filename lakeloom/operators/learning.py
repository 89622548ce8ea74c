"""Table classification job: features, split, forest, scores."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.dates import age_by_year, parse_mixed_date
from lakeloom.operators.ordered import sequence_number
from lakeloom.operators.sizing import attach
from lakeloom.session import durable


def training_set(fact: DataFrame, students: DataFrame, terms: DataFrame, as_of: str) -> DataFrame:
    """Features and label of every graded row; points are left out as they give the label away."""
    age = age_by_year(parse_mixed_date("dob"), as_of)
    return (fact.filter(F.col("grade").isNotNull())
            .join(students.select("student_id", F.col("status").alias("student_status"), age.alias("age")), "student_id")
            .join(terms.select("term_id", F.col("year").alias("term_year"), F.col("season").alias("term_season")), "term_id")
            .select("enrollment_id", "student_id", "course_id", "term_id", "dept_id", "term_year", "term_season",
                    "student_status", "age", F.col("grade").alias("label")))


def stratified_split(df: DataFrame, label: str, key: list[str], train: float = 0.8) -> DataFrame:
    """Add ``is_train``: the first ``train`` share of each label in hash order.

    The order comes from a hash of the row key, so the split is the same on
    every run and cluster; numbering is safe for one dominant label.
    """
    df = durable(df, "split")
    hashed = df.withColumn("_h", F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key])))
    numbered = sequence_number(hashed, [label], [F.col("_h"), *[F.col(k) for k in key]], "_seq")
    sizes = df.groupBy(label).agg(F.count("*").alias("_size"))
    return (attach(numbered, sizes, [label])
            .withColumn("is_train", F.col("_seq") <= F.floor(F.col("_size") * F.lit(train)))
            .drop("_h", "_seq", "_size"))


def dealt(df: DataFrame, key: list[str]) -> DataFrame:
    """The rows, written once in files of about equal size, one for each core: the split leaves few files, of one label or several,
    and the forest reads a file in one task at every level of its trees."""
    return durable(df.repartition(df.sparkSession.sparkContext.defaultParallelism, *key), "dealt")


def forest(numeric: list[str], categorical: list[str], label: str, trees: int = 50, depth: int = 10, seed: int = 42) -> Pipeline:
    """Index, one-hot, impute medians, assemble, 50 trees of depth 10."""
    index = StringIndexer(inputCols=[*categorical, label], outputCols=[*[f"{c}_ix" for c in categorical], "label_ix"],
                          handleInvalid="keep", stringOrderType="alphabetAsc")
    hot = OneHotEncoder(inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_hot" for c in categorical])
    fill = Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_num" for c in numeric])
    vector = VectorAssembler(inputCols=[*[f"{c}_num" for c in numeric], *[f"{c}_hot" for c in categorical]],
                             outputCol="features")
    trees_ = RandomForestClassifier(labelCol="label_ix", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[index, hot, fill, vector, trees_])


def train_and_save(df: DataFrame, path: str, pipeline: Pipeline, numeric: list[str]) -> PipelineModel:
    """Fit on the training rows, save, and return the model as read back."""
    rows = df.select(*[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns])
    pipeline.fit(rows).write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, numeric: list[str]) -> DataFrame:
    rows = df.select(*[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns])
    labels = model.stages[0].labelsArray[-1]
    predicted = F.array(*[F.lit(v) for v in labels])
    return model.transform(rows).withColumn("predicted", F.get(predicted, F.col("prediction").cast("int")))


def metrics(scored: DataFrame) -> dict[str, float]:
    """Accuracy and weighted F1 of scored rows."""
    ev = MulticlassClassificationEvaluator(labelCol="label_ix", predictionCol="prediction")
    return {m: ev.evaluate(scored, {ev.metricName: m}) for m in ("accuracy", "f1")}


def majority_rate(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always answering the most common label."""
    n = df.groupBy(label).agg(F.count("*").alias("n"))
    return n.agg(F.max("n").alias("largest"), F.sum("n").alias("total")).select(
        F.round(F.col("largest") / F.col("total"), 6).alias("majority_rate"), "total")


def gates(scored: DataFrame, label: str) -> DataFrame:
    """Accuracy, weighted F1, majority baseline, and the gates on accuracy: too good to be true, worse than the baseline."""
    scored = durable(scored, "scored")
    found = metrics(scored)
    accuracy = F.lit(found["accuracy"])
    return majority_rate(scored, label).select(
        accuracy.alias("accuracy"), F.lit(found["f1"]).alias("f1"), "majority_rate", "total",
        (accuracy < 0.99).alias("no_leak"), (accuracy >= 0.95 * F.col("majority_rate")).alias("not_worse"))


def confusion(scored: DataFrame, label: str = "label", n: int | None = 10) -> DataFrame:
    """The n most frequent (actual, predicted) pairs, or all of them."""
    pairs = scored.groupBy(F.col(label).alias("actual"), "predicted").agg(F.count("*").alias("n"))
    return pairs if n is None else pairs.orderBy(F.desc("n"), "actual", "predicted").limit(n)

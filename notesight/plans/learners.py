"""Learners by name. Each one draws its training rows, fits, reports feature importance, predicts, saves
and loads; the rows need subject_id, hadm_id, label (0, 1, ..) and features. Boosted trees know two classes only."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.functions.vectors import split_array
from notesight.operators.sampling import assign_folds, bags, balance

KEYS = ["subject_id", "hadm_id"]
IMPORTANCE = "feature bigint, importance double"
SEED = 12345
ROWS_PER_TASK = 5_000


def logistic_regression(seed: int, size: int, classes: int, **options) -> LogisticRegression:
    return LogisticRegression(**({"regParam": 0.3} | options))


def boosted_trees(seed: int, size: int, classes: int, **options) -> GBTClassifier | OneVsRest:
    """Boosted trees tell two classes apart; of several, each is told from the rest, all at once."""
    weight = {"weightCol": options["weightCol"]} if "weightCol" in options else {}
    trees = GBTClassifier(**({"maxIter": 10, "featureSubsetStrategy": "auto", "seed": seed} | options))
    return trees if classes == 2 else OneVsRest(classifier=trees, parallelism=classes, **weight)


def random_forest(seed: int, size: int, classes: int, **options) -> RandomForestClassifier:
    return RandomForestClassifier(**({"numTrees": 10, "featureSubsetStrategy": "auto", "seed": seed} | options))


def perceptron(seed: int, size: int, classes: int, **options) -> MultilayerPerceptronClassifier:
    layers = [size, 5, 4, classes]
    return MultilayerPerceptronClassifier(**({"layers": layers, "blockSize": 128, "maxIter": 100, "seed": seed} | options))


@dataclass(frozen=True)
class Method:
    make: Callable
    model: type[Model]
    weights: str | None

    def importance(self, model: Model) -> list[float]:
        """A weight per feature; of several classes' coefficients the one with the largest size."""
        if not self.weights:
            return []
        if isinstance(model, OneVsRestModel):
            return [sum(each) / len(each) for each in zip(*map(self.importance, model.models))]
        weights = getattr(model, self.weights).toArray()
        if weights.ndim == 2:
            weights = weights[abs(weights).argmax(0), range(weights.shape[1])]
        return [float(value) for value in weights]


LOGISTIC = Method(logistic_regression, LogisticRegressionModel, "coefficientMatrix")
BOOSTED = Method(boosted_trees, GBTClassificationModel, "featureImportances")
FOREST = Method(random_forest, RandomForestClassificationModel, "featureImportances")
PERCEPTRON = Method(perceptron, MultilayerPerceptronClassificationModel, None)


def n_classes(model: Model) -> int:
    return len(model.models) if isinstance(model, OneVsRestModel) else model.numClasses


def scored_by(model: Model, df: DataFrame, prediction: str, probability: str) -> DataFrame:
    """Add the predicted class and an array with a probability for each class. Of models for one class against the rest, the
    probabilities of the classes are brought to a sum of one."""
    vector = f"{probability}_vector"
    if not isinstance(model, OneVsRestModel):
        renamed = model.copy().setPredictionCol(prediction).setProbabilityCol(vector).setRawPredictionCol("")
        return renamed.transform(df).withColumn(probability, vector_to_array(vector)).drop(vector)
    for c, one in enumerate(model.models):
        renamed = one.copy().setPredictionCol("").setProbabilityCol(f"{vector}_{c}").setRawPredictionCol("")
        df = renamed.transform(df)
    odds = F.array(*[vector_to_array(f"{vector}_{c}")[1] for c in range(len(model.models))])
    total = F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)
    found = df.withColumn(probability, F.transform(odds, lambda p: p / total))
    likeliest = (F.array_position(probability, F.array_max(probability)) - 1).cast("double")
    return found.withColumn(prediction, likeliest).drop(*[f"{vector}_{c}" for c in range(len(model.models))])


def load_model(kind: type[Model], path: str) -> Model:
    """A saved model of a kind, or one for each class against the rest of that kind."""
    saved = SparkSession.active().read.text(os.path.join(path, "metadata")).first()[0]
    return OneVsRestModel.load(path) if "OneVsRestModel" in json.loads(saved)["class"] else kind.load(path)


def feature_count(df: DataFrame) -> int:
    """The length of the feature vectors: from the column's ML metadata, else from one row."""
    size = df.schema["features"].metadata.get("ml_attr", {}).get("num_attrs")
    if size is None:
        row = df.select(F.size(vector_to_array("features")).alias("size")).first()
        if row is None:
            raise ValueError("no rows to train on")
        size = row["size"]
    return size


def class_count(rows: DataFrame) -> int:
    """One more than the largest label, and at least two."""
    largest = rows.agg(F.max("label")).first()[0]
    return max(2, int(largest or 0) + 1)


def sized(rows: DataFrame, count: int) -> DataFrame:
    """As many tasks as `count` rows fill: an iterative fit runs a job per step, and a matched or bagged sample is often far
    smaller than the table it comes from; and trees keep 4 bytes of every feature of a row, so a task must not have many."""
    tasks, now = max(1, -(-count // ROWS_PER_TASK)), rows.rdd.getNumPartitions()
    if tasks > now:
        return rows.repartition(tasks)
    return rows.coalesce(tasks) if tasks < now else rows


def importance_table(spark: SparkSession, weights: Sequence[float]) -> DataFrame:
    return spark.createDataFrame([(i, float(weight)) for i, weight in enumerate(weights)], IMPORTANCE)


@dataclass
class Learner:
    """Fitted on all positive rows and about as many others."""

    name: str
    method: Method
    seed: int = SEED
    options: dict = field(default_factory=dict)
    model: Model | None = None

    def draw(self, df: DataFrame) -> DataFrame:
        return balance(df.select(*KEYS, "label", "features"), KEYS, self.seed)

    def train(self, df: DataFrame) -> DataFrame:
        """Fit the model; returns (feature, importance), empty if the method has none. The rows the model
        saw are `draw(df)`, the same on every call."""
        rows = self.draw(df).persist()
        try:
            self.model = self.fit(sized(rows, rows.count()), feature_count(df), class_count(rows))
        finally:
            rows.unpersist()
        return importance_table(df.sparkSession, self.method.importance(self.best_model))

    def fit(self, rows: DataFrame, size: int, classes: int) -> Model:
        return self.method.make(self.seed, size, classes, **self.options).fit(rows)

    @property
    def best_model(self) -> Model:
        if self.model is None:
            raise ValueError(f"learner {self.name} is neither trained nor loaded")
        return self.model

    def predict(self, df: DataFrame) -> DataFrame:
        """(subject_id, hadm_id, label, prediction, probability_0, .. for each class of the model)."""
        rows = df.select(*KEYS, "label", "features")
        scored = scored_by(self.best_model, rows, "prediction", "probability").drop("features")
        return split_array(scored, "probability", n_classes(self.best_model))

    def save(self, path: str) -> None:
        self.best_model.write().overwrite().save(path)

    def load(self, path: str) -> "Learner":
        self.model = load_model(self.method.model, path)
        return self


@dataclass
class CrossValidatedLearner(Learner):
    """Chosen from a parameter grid by area under the ROC curve over folds fixed by a hash of the key. Boosted trees are
    searched for two classes only."""

    grid: dict[str, Sequence] = field(default_factory=dict)
    folds: int = 5
    parallelism: int = 2

    def fit(self, rows: DataFrame, size: int, classes: int) -> Model:
        estimator = self.method.make(self.seed, size, classes, **self.options)
        builder = ParamGridBuilder()
        for name, values in self.grid.items():
            builder = builder.addGrid(estimator.getParam(name), list(values))
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=builder.build(),
            evaluator=BinaryClassificationEvaluator() if classes == 2 else MulticlassClassificationEvaluator(),
            numFolds=self.folds,
            foldCol="fold",
            parallelism=self.parallelism,
            seed=self.seed,
        )
        return search.fit(assign_folds(rows, KEYS, self.folds, self.seed))

    @property
    def best_model(self) -> Model:
        return super().best_model.bestModel

    def save(self, path: str) -> None:
        super().best_model.write().overwrite().save(path)

    def load(self, path: str) -> "Learner":
        self.model = CrossValidatorModel.load(path)
        return self


@dataclass
class BaggedLearner(Learner):
    """Many models, each on a bootstrap bag; they vote, and their probabilities and importances are
    averaged. A bag is small whatever the size of the table: its rows are drawn for all bags in one pass."""

    count: int = 20
    positives: int = 400
    others: int = 1000
    parallelism: int = 8
    models: list[Model] = field(default_factory=list)

    def draw(self, df: DataFrame) -> DataFrame:
        rows = df.select(*KEYS, "label", "features")
        return bags(rows, KEYS, self.positives, self.others, self.count, self.seed)

    def train(self, df: DataFrame) -> DataFrame:
        size = feature_count(df)
        drawn = self.draw(df).persist()
        classes = class_count(drawn)

        def fit_one(bag: int) -> Model:
            estimator = self.method.make(self.seed + bag, size, classes, weightCol="copies", **self.options)
            return estimator.fit(sized(drawn.filter(F.col("bag") == bag), self.positives + self.others))

        try:
            with ThreadPool(self.parallelism) as pool:
                self.models = pool.map(fit_one, range(1, self.count + 1))
        finally:
            drawn.unpersist()
        weights = [self.method.importance(model) for model in self.models]
        return importance_table(df.sparkSession, [sum(values) / len(values) for values in zip(*weights)])

    def predict(self, df: DataFrame) -> DataFrame:
        """As above. All models score a row in one pass, so nothing is unioned or regrouped."""
        if not self.models:
            raise ValueError(f"learner {self.name} is neither trained nor loaded")
        scored = df.select(*KEYS, "label", "features")
        for i, model in enumerate(self.models):
            scored = scored_by(model, scored, f"vote_{i}", f"odds_{i}")
        count = F.lit(float(len(self.models)))
        votes = sum((F.col(f"vote_{i}") for i in range(len(self.models))), F.lit(0.0))
        odds = [F.col(f"odds_{i}") for i in range(len(self.models))]
        # a bag may lack the last class, and its model then gives it no probability
        classes = range(max(map(n_classes, self.models)))
        mean = [
            (sum((F.coalesce(F.get(value, F.lit(c)), F.lit(0.0)) for value in odds), F.lit(0.0)) / count).alias(f"probability_{c}")
            for c in classes
        ]
        return scored.select(*KEYS, "label", F.round(votes / count).alias("prediction"), *mean)

    def save(self, path: str) -> None:
        for i, model in enumerate(self.models, 1):
            model.write().overwrite().save(os.path.join(path, f"model_{i}"))
        spark = SparkSession.active()
        spark.createDataFrame([(len(self.models),)], "models int").write.mode("overwrite").parquet(os.path.join(path, "ensemble"))

    def load(self, path: str) -> "Learner":
        count = SparkSession.active().read.parquet(os.path.join(path, "ensemble")).first()["models"]
        self.models = [load_model(self.method.model, os.path.join(path, f"model_{i}")) for i in range(1, count + 1)]
        return self


LEARNERS: dict[str, Callable[..., Learner]] = {
    "lr": lambda **o: Learner("lr", LOGISTIC, **o),
    "gbt": lambda **o: Learner("gbt", BOOSTED, **o),
    "rf": lambda **o: Learner("rf", FOREST, **o),
    "rfr": lambda **o: Learner("rf", FOREST, **o),
    "mlp": lambda **o: Learner("mlp", PERCEPTRON, **o),
    "lr_cv": lambda **o: CrossValidatedLearner("lr_cv", LOGISTIC, **({"grid": {"regParam": [0.3]}} | o)),
    "gbt_cv": lambda **o: CrossValidatedLearner(
        "gbt_cv", BOOSTED, **({"grid": {"maxIter": [10], "featureSubsetStrategy": ["auto"]}} | o)
    ),
    "lr_bagged": lambda **o: BaggedLearner("lr_bagged", LOGISTIC, **o),
    "gbt_bagged": lambda **o: BaggedLearner("gbt_bagged", BOOSTED, **o),
}


def learner(name: str, **options) -> Learner:
    if name not in LEARNERS:
        raise ValueError(f"unknown learner {name!r}; known: {', '.join(LEARNERS)}")
    return LEARNERS[name](**options)


def name_importance(importance: DataFrame, feature_map: DataFrame) -> DataFrame:
    """(feature, value, importance). Both tables have one row per feature."""
    return importance.join(feature_map, "feature").select("feature", "value", "importance")


def top_importance(named: DataFrame, count: int = 20) -> DataFrame:
    """The `count` highest and lowest weighted terms side by side."""
    from pyspark.sql import Window

    def side(order, prefix: str) -> DataFrame:
        best = named.orderBy(order, "value").limit(count)
        place = F.row_number().over(Window.orderBy(order, "value"))
        return best.select(
            place.alias("place"), F.col("value").alias(f"{prefix}_value"), F.col("importance").alias(f"{prefix}_importance")
        )

    return side(F.desc("importance"), "high").join(side(F.asc("importance"), "low"), "place")

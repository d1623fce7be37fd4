"""The classifiers on offer: how each is built, weighted, scaled and tuned."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)

from cardwatch.learners import extra_trees, linear, perceptron
from cardwatch.learners.adaboost import AdaBoostStumps
from cardwatch.learners.boosting import HistogramBooster, class_weighted
from cardwatch.learners.calibrated_svc import CalibratedSVC
from cardwatch.learners.gaussian_nb import GaussianNaiveBayes
from cardwatch.learners.knn import NearestNeighbors
from cardwatch.schema import LABEL

SEED = 42


@dataclass(frozen=True)
class Setting:
    """What a builder may need to know about the rows it will be fitted on."""

    n_features: int
    weight_sum: float
    features: str
    class_weights: tuple[float, float] = (1.0, 1.0)


@dataclass(frozen=True)
class Learner:
    name: str
    build: Callable[[dict, Setting], Estimator]
    weighting: str | None  # None, "balanced" or "positives"
    scaled: bool
    script_space: dict[str, tuple]
    notebook_space: dict[str, tuple]
    defaults: dict
    #: Growth of a booster, whose folds and trials are fitted side by side.
    preset: str | None = None
    #: Scores all rows by models of all folds that are fitted in the same jobs: (params, rows, features, label, keep, class weights by fold).
    folds_at_once: Callable | None = None
    #: As ``folds_at_once``, for any number of trials: (list of params, rows, features, label, keep, weights by fold, scaled).
    trials_at_once: Callable | None = None


def _logistic(p: dict, s: Setting) -> Estimator:
    # The penalty of a C-parametrised model, per unit of weight.
    return LogisticRegression(
        featuresCol=s.features,
        labelCol=LABEL,
        weightCol="weight",
        maxIter=p.get("max_iter", 1000),
        regParam=1.0 / (p["C"] * s.weight_sum),
        elasticNetParam=0.0,
        standardization=False,
    )


def _forest(p: dict, s: Setting) -> Estimator:
    return RandomForestClassifier(
        featuresCol=s.features,
        labelCol=LABEL,
        weightCol="weight",
        numTrees=p["n_estimators"],
        maxDepth=p["max_depth"],
        featureSubsetStrategy="sqrt",
        seed=SEED,
    )


def _extra_trees(p: dict, s: Setting) -> Estimator:
    return extra_trees.ExtremelyRandomTrees(
        featuresCol=s.features,
        labelCol=LABEL,
        trees=p["n_estimators"],
        maxDepth=p["max_depth"],
        classWeights=s.class_weights,
        seed=SEED,
    )


def _boosted(preset: str) -> Callable[[dict, Setting], Estimator]:
    def build(p: dict, s: Setting) -> Estimator:
        fit = class_weighted(p, preset)
        return HistogramBooster(
            featuresCol=s.features,
            labelCol=LABEL,
            weightCol="weight",
            preset=preset,
            rounds=fit.rounds,
            learningRate=fit.rate,
            maxDepth=fit.growth.depth,
        )

    return build


def _adaboost(p: dict, s: Setting) -> Estimator:
    return AdaBoostStumps(
        featuresCol=s.features, labelCol=LABEL, rounds=p["n_estimators"], learningRate=p["learning_rate"]
    )


def _svc(p: dict, s: Setting) -> Estimator:
    return CalibratedSVC(
        featuresCol=s.features,
        labelCol=LABEL,
        weightCol="weight",
        regParam=1.0 / (p["C"] * s.weight_sum),
        maxIter=p.get("max_iter", 100),
        folds=p.get("folds", 5),
        waves=p.get("waves", KERNEL_WAVES) if p.get("kernel", "linear") == "rbf" else 0,
        seed=SEED,
    )


#: Cosines that stand for the radial kernel, unless ``waves`` says otherwise.
KERNEL_WAVES = 256


def _knn(p: dict, s: Setting) -> Estimator:
    return NearestNeighbors(
        featuresCol=s.features,
        labelCol=LABEL,
        k=p["n_neighbors"],
        weights=p["weights"],
        maxTrainRows=p.get("max_train_rows", 0),
    )


def _naive_bayes(p: dict, s: Setting) -> Estimator:
    return GaussianNaiveBayes(featuresCol=s.features, labelCol=LABEL, smoothing=p["var_smoothing"])


def _perceptron(p: dict, s: Setting) -> Estimator:
    net = perceptron.net_of(p)
    return perceptron.PenalisedPerceptron(
        featuresCol=s.features,
        labelCol=LABEL,
        layers=list(net.hidden),
        alpha=net.alpha,
        stepSize=net.rate,
        maxIter=net.steps,
        seed=SEED,
    )


# The search spaces. Kinds: log and linear floats, integers (ends included), choices.
_BOOST_SCRIPT = {"learning_rate": ("log", 0.01, 0.3), "max_depth": ("int", 3, 9)}
_BOOST_NOTEBOOK = {
    "n_estimators": ("int", 50, 300),
    "max_depth": ("int", 3, 10),
    "learning_rate": ("log", 1e-3, 0.3),
}
_FOREST_SCRIPT = {"n_estimators": ("int", 50, 200), "max_depth": ("int", 3, 10)}
_FOREST_WIDE = {"n_estimators": ("int", 50, 200), "max_depth": ("int", 3, 15)}
_KNN = {"n_neighbors": ("int", 3, 15), "weights": ("choice", ["uniform", "distance"])}

_ALL = [
    Learner(
        "LogisticRegression", _logistic, "balanced", True,
        {"C": ("log", 1e-4, 10.0)}, {"C": ("log", 1e-4, 10.0)}, {"C": 1.0},
        trials_at_once=linear.logistic_out_of_fold,
    ),
    Learner("RandomForest", _forest, "balanced", False, _FOREST_SCRIPT, _FOREST_WIDE, {"n_estimators": 100, "max_depth": 9}),
    Learner(
        "ExtraTrees", _extra_trees, "balanced", False, _FOREST_WIDE, _FOREST_WIDE, {"n_estimators": 100, "max_depth": 11},
        folds_at_once=extra_trees.out_of_fold,
    ),
    Learner(
        "XGBoost", _boosted("xgboost"), "positives", False, _BOOST_SCRIPT, _BOOST_NOTEBOOK,
        {"learning_rate": 0.15, "max_depth": 5}, "xgboost",
    ),
    Learner(
        "LightGBM", _boosted("lightgbm"), "positives", False, _BOOST_SCRIPT, _BOOST_NOTEBOOK,
        {"learning_rate": 0.11, "max_depth": 8}, "lightgbm",
    ),
    Learner(
        "CatBoost", _boosted("catboost"), "balanced", False,
        {"learning_rate": ("log", 0.01, 0.3), "depth": ("int", 4, 8)},
        {"iterations": ("int", 50, 300), "depth": ("int", 4, 10), "learning_rate": ("log", 1e-3, 0.3)},
        # Fixed value: the rounds of that library when none are given.
        {"iterations": 1000, "learning_rate": 0.08, "depth": 6},
        "catboost",
    ),
    Learner(
        "AdaBoost", _adaboost, None, False,
        {"n_estimators": ("int", 50, 200), "learning_rate": ("log", 0.01, 1.0)},
        {"n_estimators": ("int", 50, 200), "learning_rate": ("log", 1e-3, 1.0)},
        {"n_estimators": 124, "learning_rate": 0.67},
        "adaboost",
    ),
    Learner(
        "GradientBoosting", _boosted("gradient_boosting"), None, False,
        {"n_estimators": ("int", 50, 200), "learning_rate": ("log", 0.01, 0.3), "max_depth": ("int", 3, 8)},
        {"n_estimators": ("int", 50, 200), "learning_rate": ("log", 1e-3, 0.3), "max_depth": ("int", 3, 8)},
        {"n_estimators": 191, "learning_rate": 0.27, "max_depth": 3},
        "gradient_boosting",
    ),
    Learner(
        "SVC", _svc, "balanced", True,
        {"C": ("log", 0.1, 10.0)}, {"C": ("log", 1e-2, 10.0), "kernel": ("choice", ["linear", "rbf"])}, {"C": 1.0},
    ),
    Learner("KNN", _knn, None, True, _KNN, _KNN, {"n_neighbors": 5, "weights": "distance"}),
    Learner(
        "GaussianNB", _naive_bayes, None, True,
        {"var_smoothing": ("log", 1e-9, 1e-2)}, {"var_smoothing": ("log", 1e-10, 1e-5)}, {"var_smoothing": 1e-9},
    ),
    Learner(
        "MLPClassifier", _perceptron, None, True,
        {"hidden_layer_sizes": ("choice", [[50], [100], [50, 50]]), "alpha": ("log", 1e-4, 1e-1)},
        {
            "hidden_layer_sizes": ("choice", [[50], [100], [50, 25]]),
            "alpha": ("log", 1e-5, 1e-2),
            "learning_rate_init": ("log", 1e-4, 1e-1),
        },
        {"hidden_layer_sizes": [50, 50], "alpha": 0.08},
        folds_at_once=perceptron.out_of_fold,
    ),
]

LEARNERS = {learner.name: learner for learner in _ALL}


def _built_in_boosting(p: dict, s: Setting) -> Estimator:
    return GBTClassifier(
        featuresCol=s.features,
        labelCol=LABEL,
        weightCol="weight",
        maxIter=p["n_estimators"],
        stepSize=p["learning_rate"],
        maxDepth=p["max_depth"],
        seed=SEED,
    )


#: The boosted trees that Spark has itself: labels as -1 and 1, one fit at a time. No preset uses them.
BUILT_IN_BOOSTING = Learner(
    "BuiltInBoosting", _built_in_boosting, None, False, _BOOST_SCRIPT, _BOOST_NOTEBOOK,
    {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3},
)


def notebook_variant(learner: Learner) -> Learner:
    """The same learner with the notebook's search space and without scaling; its perceptron stops after 200 iterations."""
    build, folds_at_once = learner.build, learner.folds_at_once
    if learner.name == "MLPClassifier":
        build = lambda p, s: learner.build({"max_iter": 200} | p, s)
        folds_at_once = lambda p, *rest: perceptron.out_of_fold({"max_iter": 200} | p, *rest, scaled=False)
    return replace(learner, build=build, scaled=False, script_space=learner.notebook_space, folds_at_once=folds_at_once)

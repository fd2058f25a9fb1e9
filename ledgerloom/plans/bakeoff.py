"""Classifier comparison: split, fit, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import classify as cl
from ledgerloom.plans import forms as fm
from ledgerloom.session import cut_lineage

MODELS = ("logistic", "tree", "forest", "boosted")


def fit_and_score(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str, models: Sequence[str] = MODELS, trees: int = cl.TREES, rounds: int = 20,
    depth: int = cl.DEPTH,
) -> dict[str, DataFrame]:
    """Scored test rows (key, label, prediction, score) of every requested model."""
    keep = [key, label]
    out = {}
    for name in models:
        scaler = None
        if name == "logistic":
            model, scaler = cl.logistic(train, features, label)
        elif name == "tree":
            model = cl.tree(train, features, label)
        elif name == "forest":
            model = cl.forest(train, features, label, trees, depth=depth)
        elif name == "boosted":
            model = cl.boosted(train, features, label, rounds)
        else:
            raise ValueError(f"unknown model {name}")
        out[name] = cl.predict(model, test, features, keep, scaler)
    return out


def compare_classifiers(
    rows: DataFrame, features: Sequence[str], label: str, key: str, models: Sequence[str] = MODELS, trees: int = cl.TREES, rounds: int = 20,
    depth: int = cl.DEPTH,
) -> DataFrame:
    """One report row per model on the held-out fifth of every class, best F1 first."""
    split = cut_lineage(cl.stratified_split(rows.select(key, label, *features), label, key))
    scored = fit_and_score(
        split.filter("NOT is_test"), split.filter("is_test"), features, label, key, models, trees, rounds, depth
    )
    return cl.model_comparison({n: cl.binary_report(s, label, score="score") for n, s in scored.items()})


def classify_forms(forms: DataFrame, key: str = "filename", trees: int = cl.TREES, depth: int = cl.DEPTH) -> dict[str, DataFrame]:
    """KAC against KAM from the form fields.

    Medians are taken from the training rows. Returns the report of both models, the ten largest coefficients, the
    agreement of the models and the scored test rows.
    """
    labelled = cl.stratified_split(fm.labelled(forms), "label", key)
    frame, features = fm.feature_frame(labelled, labelled.filter("NOT is_test"), key, ["is_test"])
    frame = cut_lineage(frame)
    train, test = frame.filter("NOT is_test"), frame.filter("is_test")
    model, scaler = cl.logistic(train, features, "target")
    keep = [key, "target"]
    linear = cl.predict(model, test, features, keep, scaler)
    trees_ = cl.predict(cl.forest(train, features, "target", trees, depth=depth), test, features, keep)
    return {
        "report": cl.model_comparison(
            {n: cl.binary_report(s, "target", score="score") for n, s in (("logistic", linear), ("forest", trees_))}
        ),
        "coefficients": cl.coefficient_table(train, model, features).limit(10),
        "agreement": cl.agreement(linear, trees_, key),
        "scored": linear.join(trees_.select(key, F.col("prediction").alias("forest_prediction")), key),
    }

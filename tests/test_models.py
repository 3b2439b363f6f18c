import numpy as np
import pytest

from millrace.operators import linear
from millrace.operators.linear import DECAYING_AVERAGED, Schedule, Weights
from millrace.plans import forecasts


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(800, 3)) * [1.0, 10.0, 0.1] + [0.0, 70.0, 5.0]
    y = x @ [2.0, -0.5, 3.0] + 40.0 + draw.normal(0, 0.1, 800)
    label = np.where(x[:, 0] > 0.3, "Running", np.where(x[:, 1] > 70, "Idle", "Error"))
    rows = [(*map(float, r), float(t), str(c)) for r, t, c in zip(x, y, label)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, label string").cache()


FEATURES = ["a", "b", "c"]


def error(frame, column):
    from millrace.operators import metrics

    return metrics.regression(frame.withColumn("p", column), "y", "p").first()


def test_closed_form_is_a_stationary_point(data):
    model = linear.fit_least_squares(data, FEATURES, "y", alpha=0.0)
    scaled = model.scaler.transform(data)
    step = linear.gradient_step(scaled, FEATURES, "y", model.weights, eta=1.0, alpha=0.0).first()
    assert list(step) == pytest.approx([*model.weights.coefficients, model.weights.intercept], abs=1e-6)
    assert error(data, model.prediction())["r2"] > 0.999


def test_descent_improves_with_passes(data):
    schedule = Schedule(eta=1e-3, alpha=0.0)
    from millrace.operators.scaling import Scaler

    scaled = Scaler.fit(data, FEATURES).transform(data).cache()
    errors = [error(scaled, linear.predicted(FEATURES, linear.descend(scaled, FEATURES, "y", schedule, n)))["mse"] for n in (1, 5)]
    assert errors[1] < errors[0] / 2
    averaged = linear.descend(scaled, FEATURES, "y", DECAYING_AVERAGED, 2)
    assert all(np.isfinite([*averaged.coefficients, averaged.intercept]))


def test_a_diverging_descent_keeps_finite_weights(data):
    weights = linear.descend(data, FEATURES, "y", Schedule(eta=1.0, alpha=0.0), 3)
    assert all(np.isfinite([*weights.coefficients, weights.intercept]))


def test_gradient_step_by_hand(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "x double, y double")
    step = linear.gradient_step(rows, ["x"], "y", Weights((0.5,), 0.0), eta=0.1, alpha=0.2).first()
    errors = np.array([0.5 - 2.0, 1.5 - 4.0])
    assert step["w_0"] == pytest.approx(0.5 * (1 - 0.02) - 0.1 * (errors * [1.0, 3.0]).mean())
    assert step["b"] == pytest.approx(-0.1 * errors.mean())


def test_classifier_beats_the_majority_and_survives_storage(spark, data, tmp_path):
    model = linear.fit_classifier(data, FEATURES, "label")
    assert model.classes == ("Error", "Idle", "Running")
    scored = model.transform(data)
    assert scored.where("predicted = label").count() / 800 > 0.8
    sums = scored.selectExpr("max(abs(score_0 + score_1 + score_2 - 1))").first()[0]
    assert sums < 1e-9
    forecasts.save(model, spark, str(tmp_path / "model"))
    assert forecasts.load(spark, str(tmp_path / "model")) == model


def test_newton_fit_is_the_optimum_on_any_partitions(spark, data):
    fit = linear.fit_logistic(data, FEATURES, "label", alpha=1e-2)
    assert fit.converged and fit.rounds < 20
    x = np.array(data.select(*FEATURES).collect())
    z = (x - x.mean(0)) / x.std(0)
    labels = np.array([r[0] for r in data.select("label").collect()])
    for name, w in zip(fit.model.classes, fit.model.weights):
        error = 1 / (1 + np.exp(-(x @ w.coefficients + w.intercept))) - (labels == name)
        scaled = np.array(w.coefficients) * x.std(0)
        assert np.abs(z.T @ error / len(z) + 1e-2 * scaled).max() < 1e-9 and abs(error.mean()) < 1e-9
    other = linear.fit_logistic(data.repartition(7).sortWithinPartitions("y"), FEATURES, "label", alpha=1e-2).model
    for a, b in zip(fit.model.weights, other.weights):
        assert [*a.coefficients, a.intercept] == pytest.approx([*b.coefficients, b.intercept], abs=1e-9)


def test_newton_fit_without_rows_of_one_class_and_separable(spark):
    schema = "x double, label string"
    empty = linear.fit_logistic(spark.createDataFrame([], schema), ["x"], "label")
    assert empty.model.classes == () and empty.converged
    one = linear.fit_logistic(spark.createDataFrame([(1.0, "a"), (2.0, "a"), (None, "b"), (3.0, None)], schema), ["x"], "label", rounds=8)
    assert one.model.classes == ("a",) and one.rounds == 8 and not one.converged
    apart = linear.fit_logistic(spark.createDataFrame([(float(i), "ab"[i > 4]) for i in range(10)], schema), ["x"], "label")
    assert apart.converged and np.isfinite(apart.model.weights[0].coefficients[0])


def test_forecasts_are_null_while_fields_are_missing(spark):
    fields = [*forecasts.FEATURES["power_kw"], "power_kw"]
    schema = "machine_id string, " + ", ".join(f"{c} double" for c in fields)
    rows = [("m1", *[1.0] * len(fields)), ("m2", None, *[1.0] * (len(fields) - 1))]
    from millrace.operators.linear import LinearModel
    from millrace.operators.scaling import Scaler

    features = tuple(forecasts.FEATURES["power_kw"])
    model = LinearModel(features, Scaler(dict.fromkeys(features, 0.0), dict.fromkeys(features, 1.0)), Weights((1.0,) * 8, 0.125))
    found = {r["machine_id"]: r["predicted_x"] for r in forecasts.forecast(spark.createDataFrame(rows, schema), "power_kw", {"x": model}).collect()}
    assert found == {"m1": 8.13, "m2": None}

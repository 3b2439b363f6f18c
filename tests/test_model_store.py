import pytest

from millrace.operators.linear import Classifier, LinearModel, Weights
from millrace.operators.scaling import Scaler
from millrace.plans import forecasts
from millrace.plans.model_store import ModelStore


def regressor(w):
    return LinearModel(("a", "b"), Scaler({"a": 1.0, "b": -2.5}, {"a": 1.0, "b": 0.1}), Weights((w, 1 / 3), 0.1))


CLASSES = Classifier(("a",), ("", "Idle"), (Weights((0.5,), 1.0), Weights((-0.5,), 2.0)))


def test_versions_roll_back_and_expiry(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    assert store.versions("power") == [] and store.expire("power") == [] and store.history("power").count() == 0
    with pytest.raises(LookupError):
        store.load("power")
    assert [store.publish("power", regressor(w)) for w in (1.0, 2.0, 3.0)] == [1, 2, 3]
    assert store.publish("state", CLASSES) == 1 and store.load("state") == CLASSES
    assert store.load("power") == regressor(3.0) and store.load("power", 1) == regressor(1.0)
    assert store.roll_back("power") == 4 and store.load("power") == regressor(2.0)
    assert store.roll_back("power", 1) == 5 and store.load("power") == regressor(1.0)
    history = {r["version"]: (r["restored_from"], r["rows"]) for r in store.history("power").collect()}
    assert history == {1: (None, 2), 2: (None, 2), 3: (None, 2), 4: (2, 2), 5: (1, 2)}
    assert store.expire("power", keep=2) == [1, 2, 3] and store.versions("power") == [4, 5]
    assert store.expire("power", keep=0) == [4] and store.load("power") == regressor(1.0)
    for wrong in (5, 9, None):
        with pytest.raises(LookupError):
            store.roll_back("power", wrong)
    assert store.publish("power", regressor(7.0)) == 6 and store.versions("state") == [1]


def test_a_publisher_that_dies_or_races_leaves_the_current_version(spark, tmp_path, monkeypatch):
    store = ModelStore(spark, str(tmp_path / "models"))
    store.publish("power", regressor(1.0))
    with monkeypatch.context() as m:
        m.setattr(forecasts, "lines", lambda model: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.publish("power", regressor(2.0))
    rows = spark.createDataFrame(forecasts.lines(regressor(3.0)), forecasts.ROWS)
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(str(tmp_path / "models/power/version=3"))
    assert store.versions("power") == [1] and store.load("power") == regressor(1.0)
    with pytest.raises(LookupError):
        store.load("power", 3)
    (tmp_path / "models/power/claim=4").touch()
    assert store.publish("power", regressor(4.0)) == 5 and store.load("power") == regressor(4.0)
    assert store.expire("power", keep=1) == [1]
    assert sorted(p.name for p in (tmp_path / "models/power").iterdir() if not p.name.startswith(".")) == ["claim=5", "version=5"]


def test_names_stay_below_the_root(spark, tmp_path):
    for name in ("", "../other", "a/b", ".hidden"):
        with pytest.raises(ValueError):
            ModelStore(spark, str(tmp_path)).versions(name)

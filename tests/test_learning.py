"""The sizes of the learners that the queries take by default."""

import datetime as dt

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression

from quayline.operators import learning


def test_default_sizes(spark, monkeypatch):
    seen = {}

    def cheap(name, model):
        def make(**settings):
            seen[name] = settings
            return model(featuresCol=settings["featuresCol"], labelCol=settings["labelCol"])

        monkeypatch.setattr(learning, name, make)

    cheap("RandomForestClassifier", LogisticRegression)
    cheap("GBTClassifier", LogisticRegression)
    cheap("RandomForestRegressor", LinearRegression)
    cheap("GBTRegressor", LinearRegression)
    rows = spark.createDataFrame([("A", dt.date(2025, 1, k + 1), float(k % 5), k % 2, k / 10) for k in range(20)], "ticker string, date date, f double, target_up int, target_return double")
    assert set(learning.classify(rows, rows, ["f"])) == {"logistic", "random_forest", "gradient_boosting", "ridge"}
    assert set(learning.regress(rows, rows, ["f"])) == {"linear", "ridge", "lasso", "random_forest", "gradient_boosting"}
    forests = [seen[f"RandomForest{kind}"] for kind in ("Classifier", "Regressor")]
    assert all((m["numTrees"], m["maxDepth"], m["minInstancesPerNode"]) == (300, 5, 8) for m in forests)
    boosters = [seen[f"GBT{kind}"] for kind in ("Classifier", "Regressor")]
    assert all((m["maxIter"], m["stepSize"], m["maxDepth"]) == (150, 0.05, 2) for m in boosters)


def test_learners_find_a_plain_rule(spark):
    """All models, with few trees, on rows whose target follows from a feature."""
    rows = spark.createDataFrame([(t, dt.date(2025, 1, 1) + dt.timedelta(days=k), float((k * 7 + j) % 10), float(k % 3)) for k in range(60) for j, t in enumerate("AB")], "ticker string, date date, f double, g double")
    rows = rows.selectExpr("*", "cast(f > 4 as int) as target_up", "f / 10 - 0.45 as target_return")
    train, test = learning.chronological_split(rows)
    found = learning.classify(train, test, ["f", "g"], trees=5, rounds=5)
    for name, predicted in found.items():
        m = learning.class_metrics(predicted).first()
        assert m.n_test == 36 and m.accuracy > 0.9 and m.auc > 0.95, name
    assert set(found) == {"logistic", "random_forest", "gradient_boosting", "ridge"}
    for name, predicted in learning.regress(train, test, ["f", "g"], trees=5, rounds=5).items():
        m = learning.value_metrics(predicted).first()
        assert m.n_test == 36 and m.r2 > (0.9 if name in ("linear", "lasso") else 0.0), name
    assert learning.classify(train.where("target_up = 1"), test, ["f", "g"]) == {}

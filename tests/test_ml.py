"""The classifier against direct arithmetic on the same counts."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadtally.ml import frame
from roadtally.ml.newton import newton
from roadtally.ml.report import classification_report, confusion
from roadtally.ml.scoring import describe, load_newest, newest_version, score
from roadtally.ml.training import retrain, save, train, with_prediction

AGES, SEXES, TYPES = ("16 - 20", "26 - 35", "36 - 45"), ("Female", "Male"), ("Bus", "Car")


def data(spark, n=600):
    """Severity leans on the vehicle type; rejected, blank and orphan rows are mixed in."""
    accidents, vehicles = [], []
    for i in range(n):
        kind = TYPES[i % 2]
        lean = (i * 7919) % 10
        severity = "Fatal" if kind == "Bus" and lean < 6 else "Serious" if lean < 3 else "Slight"
        accidents.append((f"K{i}", "" if i % 97 == 0 else severity))
        age = "Data missing or out of range" if i % 31 == 0 else "" if i % 37 == 0 else AGES[i % 3]
        vehicles.append((f"K{i}", age, SEXES[(i // 3) % 2], kind))
    vehicles.append(("orphan", AGES[0], SEXES[0], TYPES[0]))
    return (
        spark.createDataFrame(vehicles, "accident_index string, age_band_of_driver string, sex_of_driver string, vehicle_type string"),
        spark.createDataFrame(accidents, "accident_index string, accident_severity string"),
    )


@pytest.fixture(scope="module")
def model(spark):
    return train(*data(spark))


@pytest.fixture(scope="module")
def groups(model):
    return [r.asDict() for r in model.groups.collect()]


def test_groups_are_the_cleaned_join(spark, groups):
    vehicles, accidents = data(spark)
    rows = Counter(
        tuple(r) for r in frame.training_rows(vehicles, accidents).select(*frame.FEATURES, frame.TARGET).collect()
    )
    assert rows == {tuple(g[c] for c in (*frame.FEATURES, frame.TARGET)): g["n"] for g in groups}
    assert not {"", *frame.REJECTED} & {v for row in rows for v in row}


def test_split_holds_out_the_rounded_share_of_each_class(spark, groups):
    sizes = Counter()
    for g in groups:
        assert 0 <= g["n_test"] <= g["n"] and g["n_train"] + g["n_test"] == g["n"]
        sizes[g[frame.TARGET], "n"] += g["n"]
        sizes[g[frame.TARGET], "test"] += g["n_test"]
    for label in {g[frame.TARGET] for g in groups}:
        assert sizes[label, "test"] == (20 * sizes[label, "n"] + 50) // 100
    other_seed = frame.split_groups(*data(spark), seed=7).select("n", "n_test").collect()
    assert sum(r["n"] for r in other_seed) == sum(g["n"] for g in groups)
    assert sorted(r["n_test"] for r in other_seed) != sorted(g["n_test"] for g in groups)


@pytest.mark.parametrize("percent", [0, 1, 50, 99, 100])
def test_split_of_copies_and_small_classes(spark, percent):
    """A mass of copies of one row is cut in two; a class of one row is held out or not as a whole."""
    row = (AGES[0], SEXES[0], TYPES[0])
    vehicles = [("A", *row)] * 501 + [("B", *row)] + [("C", AGES[1], SEXES[0], TYPES[1])] * 3
    accidents = [("A", "Slight"), ("B", "Fatal"), ("C", "Slight"), ("C", "Serious"), ("C", "Serious")]
    split = frame.split_groups(
        spark.createDataFrame(vehicles, "accident_index string, age_band_of_driver string, sex_of_driver string, vehicle_type string"),
        spark.createDataFrame(accidents, "accident_index string, accident_severity string"),
        percent,
    ).collect()
    sizes = {c: (sum(r["n"] for r in split if r[frame.TARGET] == c), sum(r["n_test"] for r in split if r[frame.TARGET] == c)) for c in ("Slight", "Fatal", "Serious")}
    assert {c: n for c, (n, _) in sizes.items()} == {"Slight": 504, "Fatal": 1, "Serious": 6}
    assert all(held == (n * percent + 50) // 100 for n, held in sizes.values())


def test_split_of_nothing(spark):
    vehicles, accidents = data(spark)
    assert frame.split_groups(vehicles.limit(0), accidents).collect() == []


def test_class_weights_by_hand(spark):
    counts = spark.createDataFrame([("a", 6), ("b", 3), ("c", 1)], "accident_severity string, n_train bigint")
    weights = {r[0]: r["weight"] for r in frame.class_weights(counts).collect()}
    assert weights == pytest.approx({"a": 10 / 18, "b": 10 / 9, "c": 10 / 3})


def design(groups, classes):
    x = np.array([[float(g[c] == v) for c, values in zip(frame.FEATURES, (AGES, SEXES, TYPES)) for v in values] for g in groups])
    label = np.array([classes.index(g[frame.TARGET]) for g in groups])
    n = np.array([g["n_train"] for g in groups], float)
    per_class = np.array([n[label == k].sum() for k in range(len(classes))])
    weight = n * (n.sum() / (len(classes) * per_class))[label]
    return x, label, weight


def test_fit_is_the_balanced_penalised_optimum(model, groups):
    """The gradient of sum(weighted log loss) + |w|^2 / 2 vanishes at the fitted coefficients."""
    classifier = model.pipeline.stages[-1]
    w, b = classifier.coefficientMatrix.toArray(), classifier.interceptVector.toArray()
    x, label, weight = design(groups, model.classes)
    scores = x @ w.T + b
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    error = (p - np.eye(len(model.classes))[label]) * weight[:, None]
    assert np.abs(error.T @ x + w).max() < 0.05  # of some 400 weighted rows
    assert np.abs(error.sum(axis=0)).max() < 0.05


def test_many_rows_move_no_coefficient_by_rounding(spark):
    """With hundreds of millions of rows the sums are rounded by more than the penalty's pull; the steps must still end."""
    rng = np.random.default_rng(7)
    slots = [(0, 1 + a, 5 + b, 7 + c) for a in range(4) for b in range(2) for c in range(12)]
    weight = rng.uniform(1e5, 4e6, (len(slots), 3))
    rows = [([int(i) for i in s], k, float(weight[at, k])) for at, s in enumerate(slots) for k in range(3)]
    fitted = newton(spark.createDataFrame(rows, "slots array<int>, label int, weight double").coalesce(3), 3, 19)
    for first, last in ((1, 5), (5, 7), (7, 19)):
        assert np.abs(fitted[:, first:last].sum(axis=1)).max() < 1e-9  # only the penalty decides these sums


def test_model_uses_the_signal(model):
    """Balanced weights aim at recall of every class: better than always naming one of three."""
    predicted = with_prediction(model.groups, model.pipeline, model.classes)
    report = {r["class"]: r for r in classification_report(confusion(predicted, "n_test")).collect()}
    assert report["macro avg"]["recall"] > 0.4
    assert report["accuracy"]["f1"] == pytest.approx(model.metadata.first()["accuracy_test"])


def test_metadata(model):
    meta = model.metadata.first()
    assert meta["n_samples_total"] == meta["n_samples_train"] + meta["n_samples_test"]
    assert meta["feature_options"]["vehicle_type"] == ["Bus", "Car"]
    assert sum(meta["target_distribution"].values()) == pytest.approx(1)


def test_report_by_hand(spark):
    matrix = spark.createDataFrame([("a", "a", 8), ("a", "b", 2), ("b", "a", 4), ("b", "b", 6), ("c", "a", 5)], "actual string, predicted string, n bigint")
    report = {r["class"]: r.asDict() for r in classification_report(matrix).collect()}
    assert report["a"]["precision"] == pytest.approx(8 / 17) and report["a"]["recall"] == pytest.approx(0.8)
    assert report["c"] == {"class": "c", "precision": 0.0, "recall": 0.0, "f1": 0.0, "support": 5}
    assert report["accuracy"]["f1"] == pytest.approx(14 / 25)
    assert report["macro avg"]["recall"] == pytest.approx((0.8 + 0.6 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(14 / 25)


def test_score_and_versions(spark, model, tmp_path):
    root = str(tmp_path)
    with pytest.raises(Exception):
        newest_version(spark, root)
    save(model, root)
    newer = train(*data(spark, 900))
    save(newer, root)
    (tmp_path / "version=torn" / "model").mkdir(parents=True)
    pipeline, metadata = load_newest(spark, root)
    assert metadata["n_samples_total"] == newer.metadata.first()["n_samples_total"]
    rows = spark.createDataFrame(
        [(1, AGES[0], "Male", "Bus"), (2, "new", "new", "new"), (3, None, None, None)], "id int, age_band_of_driver string, sex_of_driver string, vehicle_type string"
    )
    scored = {r["id"]: r for r in score(rows, pipeline, metadata).collect()}
    plan = score(rows, pipeline, metadata)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan  # the model is applied where the rows are
    first = scored[1]
    assert first["predicted_severity"] == "Fatal" == first["ranked"][0]["class"] == max(first["probabilities"], key=first["probabilities"].get)
    assert sum(first["probabilities"].values()) == pytest.approx(1)
    assert [round(r["probability"] * 100, 1) for r in first["ranked"]] == pytest.approx([r["percent"] for r in first["ranked"]], abs=0.11)
    assert scored[2]["probabilities"] == scored[3]["probabilities"]  # unknown and missing both encode to zeros
    assert describe(metadata)["classes"] == ["Fatal", "Serious", "Slight"]


def test_retrain_guards(spark, tmp_path):
    vehicles, accidents = data(spark, 60)
    with pytest.raises(ValueError, match="too few"):
        train(vehicles, accidents)
    with pytest.raises(ValueError, match="no accidents"):
        train(vehicles, accidents.limit(0))
    vehicles, accidents = data(spark)
    accidents.write.parquet(f"{tmp_path}/a/part1")
    vehicles.write.parquet(f"{tmp_path}/v/part1")
    retrain(spark, f"{tmp_path}/a", f"{tmp_path}/v", f"{tmp_path}/models")
    assert load_newest(spark, f"{tmp_path}/models")[1]["n_samples_total"] > 100

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtally.operators import accounts, models, quality, registry, rollups


def at(hour):
    return dt.datetime(2026, 1, 1, hour)


@pytest.fixture(scope="module")
def people(spark):
    users = spark.createDataFrame(
        [(1, "ann", "analyst", True), (2, "bob", "user", True), (3, "cat", "admin", False), (4, "dan", "Analyst", None)],
        "id long, username string, role string, is_active boolean",
    )
    sessions = spark.createDataFrame(
        [("s1", 1, at(1), at(2), True), ("s2", 1, at(3), at(4), True), ("s3", 2, None, at(5), False), ("s4", 9, at(6), at(7), True),
         ("s5", 3, at(8), at(9), True)],
        "session_token string, user_id long, created_at timestamp, expires_at timestamp, is_active boolean",
    )
    return users, sessions


def test_session_reports(people):
    users, sessions = people
    assert tuple(accounts.account_kpis(users, sessions).first()) == (4, 4, 2, 2)
    logins = {r.user_id: r.last_login for r in accounts.last_login(sessions).collect()}
    assert (logins[1], logins[2]) == (at(3), at(5))
    status = {r.username: r.status for r in accounts.user_status(users, sessions).collect()}
    assert status == {"ann": "Online", "bob": "Offline", "cat": "Disabled", "dan": "Offline"}
    assert [r.username for r in accounts.users_online(users, sessions).collect()] == ["ann"]
    assert sorted(r.username for r in accounts.users_offline(users, sessions).collect()) == ["bob", "dan"]


def test_session_listing(people):
    users, sessions = people
    joined = {r.session_token: r.username for r in accounts.sessions_with_users(sessions, users).collect()}
    assert joined == {"s1": "ann", "s2": "ann", "s3": "bob", "s4": None, "s5": "cat"}
    page = accounts.list_sessions(sessions, users, limit=2).collect()
    assert [(r.session_token, r.username, r.total) for r in page] == [("s5", "cat", 5), ("s4", None, 5)]
    assert [r.session_token for r in accounts.list_sessions(sessions, users, username=" ANN ").collect()] == ["s2", "s1"]
    assert accounts.list_sessions(sessions, users, username="nobody").collect() == []


def test_user_listing(people):
    users, _ = people
    assert [r.username for r in accounts.list_users(users, role="ANALYST").collect()] == ["ann", "dan"]
    assert [r.username for r in accounts.list_users(users, search="A", limit=1, offset=1).collect()] == ["cat"]
    assert accounts.list_users(users, username=" Bob ", user_id=2, active=True).first().total == 1


def events(spark, *rows):
    return spark.createDataFrame(
        [(d, a, at(h), i) for i, (d, a, h) in enumerate(rows)], "dataset_id long, action string, event_time timestamp, seq long"
    )


@pytest.mark.parametrize(
    ("rows", "active"),
    [
        ([(1, "upload", 1), (2, "upload", 2)], [2]),
        ([(1, "upload", 1), (2, "upload", 2), (1, "activate", 3)], [1]),
        ([(1, "upload", 1), (2, "upload", 2), (1, "deactivate", 3)], []),
        ([(1, "upload", 5), (2, "upload", 5)], [2]),
    ],
)
def test_at_most_one_active_dataset(spark, rows, active):
    state = registry.dataset_state(events(spark, *rows)).collect()
    assert [r.dataset_id for r in state if r.active] == active


def test_dataset_lookup(spark, make_ads):
    ds = spark.createDataFrame(
        [(i, f"f{i}", i % 2 == 0, at(i)) for i in range(1, 8)], "id long, file_name string, active boolean, created_at timestamp"
    )
    assert registry.active_dataset(ds).first().id == 6
    assert [r.id for r in registry.dataset_history(ds, 0).collect()] == [7]
    assert registry.has_data(ds, spark.range(0)) and registry.has_data(ds.limit(0), spark.range(1))
    assert not registry.has_data(ds.limit(0), spark.range(0))
    summary = rollups.summary(quality.score_ads(make_ads({})))
    row = registry.dashboard_overview(summary, ds).first()
    assert (row.total_records, row.has_data, row.active_dataset.id) == (1, True, 6)
    assert [d.id for d in row.dataset_history] == [7, 6, 5, 4, 3]
    none = registry.dashboard_overview(summary, ds.limit(0)).first()
    assert none.active_dataset is None and none.dataset_history == []


def test_lifecycle_events(spark):
    made = registry.lifecycle_event(spark.createDataFrame([(5,)], "id long"), "activate")
    assert (made.first().dataset_id, made.first().action) == (5, "activate")
    with pytest.raises(ValueError):
        registry.lifecycle_event(spark.range(1), "erase")


def test_latest_runs(spark):
    runs = spark.createDataFrame(
        [(1, "a", "FAILED", at(1)), (2, "a", "SUCCESS", at(2)), (3, "b", "FAILED", at(1))],
        "id long, job string, status string, completed_at timestamp",
    )
    assert {r.job: r.status for r in registry.latest_runs(runs).collect()} == {"a": "SUCCESS", "b": "FAILED"}


@pytest.fixture(scope="module")
def scored(make_ads):
    rng = np.random.default_rng(0)
    rows = [
        dict(impressions=int(rng.integers(500, 5000)), clicks=int(rng.integers(1, 300)), conversions=int(rng.integers(0, 20)),
             spend=float(rng.integers(1, 900)) / 10)
        for _ in range(80)
    ]
    return quality.score_ads(make_ads(*rows)).cache()


def test_too_few_rows(scored, tmp_path):
    assert models.train_classifier(scored.limit(9), str(tmp_path)).summary == {"status": "insufficient_data", "records_used": 9}
    assert models.train_predictor(scored.limit(4), str(tmp_path)).summary == {"status": "insufficient_data", "records_used": 4}


def test_predictor_is_least_squares(scored, tmp_path):
    trained = models.train_predictor(scored, str(tmp_path))
    rows = scored.collect()
    x = np.array([[1.0, *(float(r[n]) for n in models.PREDICTOR_FEATURES)] for r in rows])
    y = np.array([float(r.conversions) for r in rows])
    fit = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    r2 = 1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert (trained.summary["status"], trained.summary["records_used"]) == ("trained", 80)
    assert trained.summary["r2_score"] == pytest.approx(r2, abs=1e-4)
    got = models.predict_conversions(trained.model, scored.select("ad_id", *models.PREDICTOR_FEATURES)).collect()
    want = {r.ad_id: max(0.0, f) for r, f in zip(rows, fit)}
    assert all(abs(r.predicted_conversions - want[r.ad_id]) < 0.006 and r.confidence == "medium" for r in got)


def test_classifier_learns_the_labels_and_survives_saving(scored, tmp_path):
    out = models.retrain(scored, str(tmp_path))
    assert out["classifier"]["status"] == out["predictor"]["status"] == "trained"
    model = models.load(out["classifier"]["model_path"])
    rows = models.predict_effectiveness(model, scored.select("ad_id", "quality_label", *models.CLASSIFIER_FEATURES)).collect()
    level = {"good": "high", "average": "medium", "bad": "low"}
    assert np.mean([level[r.quality_label] == r.prediction_label for r in rows]) > 0.8
    for r in rows:
        assert set(r.probabilities) == set(models.EFFECTIVENESS)
        assert sum(r.probabilities.values()) == pytest.approx(1) and r.confidence == max(r.probabilities.values())


def test_classifier_taught_by_cells(scored, tmp_path):
    """Rows counted per cell of bins teach the labels as well as rows do; repeats change nothing but weights."""
    many = scored.crossJoin(scored.sparkSession.range(100).select())
    trained = models.train_classifier(many, str(tmp_path), cells_beyond=1000)
    assert trained.summary["records_used"] == many.count() == 8000
    assert type(trained.model.stages[0]).__name__ == "Bucketizer"
    rows = models.predict_effectiveness(models.load(str(tmp_path)), scored.select("ad_id", "quality_label", *models.CLASSIFIER_FEATURES)).collect()
    level = {"good": "high", "average": "medium", "bad": "low"}
    assert np.mean([level[r.quality_label] == r.prediction_label for r in rows]) > 0.8
    assert all(sum(r.probabilities.values()) == pytest.approx(1) for r in rows)


def test_scores_are_written_once(scored, tmp_path, monkeypatch):
    names, written = [], models.written
    model = models.train_conversion_model(scored, str(tmp_path / "m"))
    monkeypatch.setattr(models, "written", lambda df, name: names.append(name) or written(df, name))
    models.evaluate(scored, model)
    assert names == ["scores"]


def test_one_class_only(scored, tmp_path):
    rows = scored.withColumn("quality_label", F.lit("bad"))
    model = models.train_classifier(rows, str(tmp_path)).model
    out = models.predict_effectiveness(model, rows.select(*models.CLASSIFIER_FEATURES)).first()
    assert out.prediction_label == "low" and (out.probabilities["high"], out.probabilities["medium"]) == (0.0, 0.0)


def test_evaluation_contract(spark, scored, tmp_path):
    model = models.train_conversion_model(scored, str(tmp_path / "m"))
    rows = {r.section: r for r in models.evaluate(scored, model).collect()}
    assert set(rows) == {"rule_baseline", "logistic_regression", "delta"}
    for m in models.METRICS:
        assert 0 <= rows["rule_baseline"][m] <= 1 and 0 <= rows["logistic_regression"][m] <= 1
        assert rows["delta"][m] == pytest.approx(rows["logistic_regression"][m] - rows["rule_baseline"][m])
    top = models.top_features(spark, model).collect()
    assert [abs(r.coefficient) for r in top] == sorted((r.abs_coefficient for r in top), reverse=True)

from unittest.mock import MagicMock

import pytest

from edugauge.ml.models import PUPIL_FOREST
from workloads import models as workload


@pytest.mark.parametrize(
    "query, plan, function, given",
    [
        ("rf_compare", "pupil_model", "compare", ("train", "test")),
        ("cv_search", "pupil_model", "tune", ("train", "test", ["pupil_key"])),
        ("shapley", "pupil_model", "explain", ("train", "test", ["pupil_key"])),
        ("goal_model", "municipal_model", "goal_model", ("train", "test")),
        ("goal_thresholds", "municipal_model", "goal_model", ("train", "test")),
        ("goal_grid_search", "municipal_model", "tune", ("train", "test")),
        ("risk_model", "municipal_model", "risk", ("goals", "external", "levels")),
        ("risk_alerts", "municipal_model", "risk", ("goals", "external", "levels")),
        ("risk_agreement", "municipal_model", "risk", ("goals", "external", "levels")),
        ("kmeans_k", "municipal_model", "clusters", ("goals", "external")),
        ("cluster_by_region", "municipal_model", "clusters", ("goals", "external")),
        ("cluster_members", "municipal_model", "clusters", ("goals", "external")),
        ("cluster_profile", "municipal_model", "clusters", ("goals", "external")),
    ],
)
def test_queries_leave_the_plans_their_parameters(monkeypatch, query, plan, function, given):
    monkeypatch.setattr(workload, "_split", lambda *_: ("train", "test"))
    monkeypatch.setattr(workload, "_goals", lambda *_: ("goals", "external"))
    monkeypatch.setattr(workload, "gold_frame", lambda *_: "levels")
    monkeypatch.setattr(workload.municipal_model, "split", lambda *_: ("train", "test"))
    called = MagicMock(return_value=(MagicMock(), None) if function == "goal_model" else MagicMock())
    monkeypatch.setattr(getattr(workload, plan), function, called)
    getattr(workload, query)(None, "sf")
    called.assert_called_once_with(*given)


def test_forest_by_state_is_the_tuned_one(monkeypatch):
    monkeypatch.setattr(workload, "_split", lambda *_: ("train", "test"))
    monkeypatch.setattr(workload.models, "fit", lambda train, spec, *_: spec)
    monkeypatch.setattr(workload.models, "group_report", lambda fitted, *_: fitted)
    assert PUPIL_FOREST.items() <= dict(workload.rf_by_state(None, "sf").params).items()

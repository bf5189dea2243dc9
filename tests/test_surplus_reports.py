"""The quality reports score the model beside the baseline."""

from __future__ import annotations

from pitval.queries import ORACLES, callables

FOLDER = "/root/testdata/sf0.001"
BOTH = ["naive_surplus", "predicted_surplus"]


def test_model_leg_is_reported(spark):
    rows = callables()["surplus_accuracy_model"](spark, FOLDER).collect()
    assert sorted(r["score"] for r in rows) == BOTH
    assert len({r["base_rate"] for r in rows}) == 1 and len({r["rho"] for r in rows}) == 2
    assert {"surplus_accuracy_model", "pair_gap_median_model"} <= set(ORACLES)

"""Merchant tables whose pairs move twice, with merchants of every size."""

import pytest

from ledgerlift.plans import incremental, upgrade
from ledgerlift.plans.incremental import SCORES, STATS, MerchantState
from ledgerlift.session import recorded_plans
from tests.conftest import rows
from tests.test_window_matches import _imp, _tx


@pytest.mark.parametrize("most", [1 << 18, 9, 0])
def test_merchant_ranks_by_windows_and_slices(spark, tmp_dir, monkeypatch, most):
    """All merchants in windows, some too large for one, all too large."""
    monkeypatch.setattr(incremental, "WINDOW_PAIRS", most)
    state, imp, seen = MerchantState(spark, tmp_dir, threshold=40, top_pct=0.4, low_pct=0.5, buckets=4), _imp(spark), []
    for version in range(2):
        batch = [r[1:] for r in _tx(150, version)] + [("C1", "SMALL")]
        seen += batch
        with recorded_plans() as plans:
            state.apply(spark.createDataFrame(batch, "customer string, merchant string"), imp, version, "2025-01-01 00:00:00")
        assert ("__ll_slice" in "\n".join(plans)) == (most < 1 << 18)
    tx = spark.createDataFrame(seen, "customer string, merchant string")
    cols = ("customer", "merchant", "transaction_count", "merchant_rank")
    assert rows(state.tables.read(STATS), *cols) == rows(upgrade.customer_stats(tx), *cols)
    cols = ("customer", "merchant", "avg_weight", "weight_rank")
    assert rows(state.tables.read(SCORES), *cols) == rows(upgrade.importance_scores(tx, imp), *cols)
    want = upgrade.detect_upgrades(tx, imp, 40, 0.4, 0.5, detected_at="x")
    assert rows(state.detections(), "customer", "merchant") == rows(want, "customer", "merchant")

"""ledgerlift: merchant/customer upgrade analytics as Spark DataFrame plans.

Batch entry points live in :mod:`ledgerlift.plans`, reusable relational
building blocks in :mod:`ledgerlift.operators`, readers in
:mod:`ledgerlift.sources`, writers in :mod:`ledgerlift.sinks` and the
checkpointed file stream in :mod:`ledgerlift.streaming`.
"""

from ledgerlift.plans.upgrade import (
    customer_stats,
    detect_upgrades,
    detection_records,
    eligible_merchants,
    importance_scores,
    pattern_matches,
)

__all__ = [
    "customer_stats",
    "detect_upgrades",
    "detection_records",
    "eligible_merchants",
    "importance_scores",
    "pattern_matches",
]

"""veilmark: classify columns, mask tables for an access tier, audit both, on Spark."""

from veilmark.functions.masks import MASKS
from veilmark.functions.tiers import FULL, NONE, PARTIAL, resolve_tier, tier_of_groups
from veilmark.operators.masking import masked, write_masked

__all__ = [
    "FULL",
    "MASKS",
    "NONE",
    "PARTIAL",
    "masked",
    "resolve_tier",
    "tier_of_groups",
    "write_masked",
]

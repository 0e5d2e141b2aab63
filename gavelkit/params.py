"""Job parameters. Every rule value can be changed by the caller."""

from __future__ import annotations

from dataclasses import dataclass

from gavelkit.functions import fixed


@dataclass(frozen=True)
class Params:
    run_date: str
    brand_pattern: str = ""
    price_floor: float = fixed.PRICE_FLOOR
    new_days: int = fixed.NEW_DAYS
    closed_days: int = fixed.CLOSED_DAYS
    sales_days: int = fixed.SALES_DAYS
    alert_threshold: float = fixed.ALERT_THRESHOLD
    backfill_count: int = fixed.BACKFILL_COUNT
    min_tag_count: int = fixed.MIN_TAG_COUNT
    top_dealers: int = fixed.TOP_DEALERS
    stats_keep: int = fixed.STATS_KEEP

    def __post_init__(self) -> None:
        # zero, negative zero and not-a-number fall back to the default threshold
        t = self.alert_threshold
        if not t or t != t:
            object.__setattr__(self, "alert_threshold", fixed.ALERT_THRESHOLD)

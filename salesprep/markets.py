"""What differs between markets, held as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Fixed values of the outlet rules.
MISSING_CODE = "NA"
DISTRIBUTOR_CHANNEL = "DISTRIBUTOR"
INVALID_STORE_CODES = ("NA", "Not Available", "Pareto")
INVALID_OUTLET_CODES = ("NA", "Not Available", "Pareto", "Unknown")
PHARMACY_BUCKETS = ("Pharmacy", "WSPharmacy")
ESTIMATED_BUCKET = "Based on"
ADJUSTMENT_STORES = "ZOOM|ADJ"
COUNTER_WORD = "COUNTER"
OUTLET_PREFIX = "SF"
OTHER_CATEGORY = "Others"
AREA_FIXES = {
    "ASM_CHENNAI-Home": "ASM_CHENNAI-HOME",
    "ASM_HP JK/CHD": "ASM_HP JKCHD",
}
CHANNEL_OVERRIDES = {"1000061620": "DISTRIBUTOR"}


@dataclass(frozen=True)
class WindowRule:
    """Which months a market loads, relative to the run date.

    The first month is ``first_month`` (``yyyyMM``) or ``months_back`` before the
    run date. The last month is the previous one; with ``open_at_month_end`` it
    is the current one when the run date ends a month. ``always`` rules win over
    months given by the caller.
    """

    first_month: str | None = None
    months_back: int | None = None
    open_at_month_end: bool = False
    always: bool = False


@dataclass(frozen=True)
class MarketProfile:
    name: str
    window: WindowRule | None = None
    file_source: bool = False
    # country extract
    extract: bool = True
    trim_channel: bool = False
    channel_overrides: Mapping[str, str] = field(default_factory=dict)
    distributor_recode: tuple[str, str] | None = None
    listed_distributors: bool = False
    store_with_distributor: bool = False
    outlet_rules: bool = False
    area_fixes: Mapping[str, str] = field(default_factory=lambda: dict(AREA_FIXES))
    correct_partners: bool = True
    keep_raw_copy: bool = False
    # region preparation
    focus_months: int | None = None
    restricted_skus: bool = False
    active_months: int | None = None
    route_stores: bool = True


PROFILES = {
    profile.name: profile
    for profile in (
        MarketProfile(
            name="INDIA_HOME",
            window=WindowRule(months_back=36),
            extract=False,
            keep_raw_copy=True,
            route_stores=False,
        ),
        MarketProfile(
            name="INDIA_HEALTH",
            window=WindowRule(months_back=25, always=True),
            file_source=True,
            channel_overrides=CHANNEL_OVERRIDES,
            outlet_rules=True,
            keep_raw_copy=True,
            focus_months=6,
            restricted_skus=True,
            route_stores=False,
        ),
        MarketProfile(
            name="PAK_HEALTH",
            window=WindowRule(months_back=36),
            file_source=True,
            trim_channel=True,
            channel_overrides=CHANNEL_OVERRIDES,
            keep_raw_copy=True,
            focus_months=6,
            restricted_skus=True,
            route_stores=False,
        ),
        MarketProfile(
            name="PAKISTAN_HOME",
            window=WindowRule(first_month="201701", open_at_month_end=True),
            distributor_recode=("341", "161"),
            listed_distributors=True,
            store_with_distributor=True,
            correct_partners=False,
            active_months=4,
            route_stores=False,
        ),
        MarketProfile(
            name="INDO_HOME",
            window=WindowRule(months_back=38, open_at_month_end=True),
            listed_distributors=True,
        ),
        MarketProfile(name="INDO_HEALTH", extract=False),
        MarketProfile(name="MY_HEALTH", extract=False, focus_months=5, route_stores=False),
    )
}


def profile(name: str) -> MarketProfile:
    if name not in PROFILES:
        raise ValueError(f"no profile for market {name!r}")
    return PROFILES[name]

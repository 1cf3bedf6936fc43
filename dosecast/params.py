"""Run parameters. Nothing here reads the wall clock: the caller states the dates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from dosecast.fixed_values import EXCLUDED_STATUSES

MATCH_MODES = ("tiered", "exclusive", "flat")


@dataclass(frozen=True)
class ForecastParams:
    """Everything the forecast needs besides its two input tables.

    ``match_mode``
        ``tiered``: country rows and generic rows both match, then generic drugs that a country row
        overrides are suppressed. ``exclusive``: generic rows only for subjects without a country row.
        ``flat``: four keys, country ignored.
    ``renumber_missed``
        Also advance the cycle number over the cycles skipped by the roll-forward.
    ``both_drugs``
        One plan row for the primary and one for the additional drug, instead of primary first.
    ``subject_order`` / ``mapping_order``
        Columns that say which row comes first where a plan row is built from several. A row hash
        breaks the remaining ties, so results never depend on partitioning. CSV input ranks by file and row where
        these are left at their defaults.
    ``broadcast_bytes``
        A mapping-side table is broadcast only if its measured size stays within this.
    """

    as_of_date: dt.date
    run_timestamp: dt.datetime | None = None
    horizon_days: int = 365
    excluded_statuses: tuple[str, ...] = EXCLUDED_STATUSES
    match_mode: str = "tiered"
    renumber_missed: bool = False
    both_drugs: bool = False
    default_cycle_days: int = 28
    subject_order: tuple[str, ...] = ("extract_date",)
    mapping_order: tuple[str, ...] = ()
    broadcast_bytes: int = 64 * 1024 * 1024

    def __post_init__(self) -> None:
        if self.match_mode not in MATCH_MODES:
            raise ValueError(f"match_mode must be one of {MATCH_MODES}, not {self.match_mode!r}")
        if self.horizon_days < 0:
            raise ValueError("horizon_days must not be negative")

    @property
    def horizon_date(self) -> dt.date:
        return self.as_of_date + dt.timedelta(days=self.horizon_days)

    @property
    def stamp(self) -> dt.datetime:
        """Run timestamp; midnight of the as-of date unless the caller gives one."""
        return self.run_timestamp or dt.datetime.combine(self.as_of_date, dt.time())

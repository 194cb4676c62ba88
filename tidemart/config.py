"""Settings of a run. Nothing in the library reads the clock: ``as_of`` stands for today."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Settings:
    as_of: date = date(2001, 8, 2)
    sales_threshold: float = 10_000.0
    spine_start: date = date(1995, 1, 1)
    spine_end: date = date(2002, 1, 1)  #: exclusive
    scd2_end: date = date(2099, 12, 31)
    batch_id: str = "batch"
    source_system: str = "BATCH"
    shifted_day_names: bool = False  #: name days one off, as older reports do
    office_with_space: bool = False  #: let 'OFFICE SUPPLIES' count as traditional, not only 'OFFICE_SUPPLIES'
    stream_names: tuple[str, ...] = ("KAFKA", "STREAMING")  #: source systems that count as streaming


DEFAULT = Settings()

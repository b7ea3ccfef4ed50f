"""Run modes of the silver jobs.

``incremental`` merges recent hour partitions one by one: hours are separate
units of work, so one that fails is kept for the report while the rest run.
``backfill`` is one merge over everything.  Both may be repeated at will, as
the merges are idempotent.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from tidewatch.sources.bronze import hours_to_process

logger = logging.getLogger(__name__)

Hour = dict[str, str]
Merge = Callable[[list[Hour] | None], object]


@dataclass
class RunReport:
    """What a run did: the hours merged (``None`` for a backfill) and what went wrong."""

    mode: str
    merged: list[Hour] | None = None
    causes: dict[str, Exception] = field(default_factory=dict)

    @property
    def complete(self) -> bool:
        return not self.causes


class HoursFailed(RuntimeError):
    """Some hours could not be merged; ``report`` tells which and why."""

    def __init__(self, report: RunReport):
        self.report = report
        told = "; ".join(f"{name}: {cause!r}" for name, cause in report.causes.items())
        super().__init__(f"{len(report.causes)} hour(s) not merged ({told})")


def hour_name(hour: Hour) -> str:
    return "/".join(f"{part}={value}" for part, value in hour.items())


def incremental(merge: Merge, now: dt.datetime | None = None, lookback_hours: int = 1) -> RunReport:
    """Merge the current hour and those before it, each on its own."""
    report = RunReport("incremental", merged=[])
    for hour in hours_to_process(now, lookback_hours):
        try:
            merge([hour])
        except Exception as cause:  # noqa: BLE001  the other hours still have their turn
            report.causes[hour_name(hour)] = cause
            logger.warning("merge of %s gave up", hour_name(hour), exc_info=cause)
        else:
            report.merged.append(hour)
    if not report.complete:
        raise HoursFailed(report) from next(iter(report.causes.values()))
    return report


def backfill(merge: Merge) -> RunReport:
    merge(None)
    return RunReport("backfill")


def run(payload: dict | None, merge: Merge, now: dt.datetime | None = None) -> RunReport:
    """Choose the mode by the payload: a true ``backfill`` entry, else incremental."""
    return backfill(merge) if payload and payload.get("backfill") else incremental(merge, now)

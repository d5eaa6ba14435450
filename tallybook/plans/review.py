"""The whole review of a portfolio table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from tallybook.calibration import BAND_WEIGHT, BANDS
from tallybook.operators.expectations import at_limit, review_expectations
from tallybook.operators.reports import (
    BAND_METRICS,
    PTI_LABELS,
    REVIEW,
    band_mix,
    pti_buckets,
    segment_profile,
)
from tallybook.params import Scenario
from tallybook.sources.store import write_report


class Review(Mapping):
    """Review reports by name. A report is built, and its quantiles counted, when it is asked for."""

    def __init__(self, portfolio: DataFrame, names: Iterable[str]):
        self._portfolio, self._names = portfolio, tuple(names)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = REVIEW[name](self._portfolio)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def review(portfolio: DataFrame, names: Iterable[str] = tuple(REVIEW)) -> Review:
    """The review of a stored table; on unscored keys every report would score them again."""
    return Review(portfolio, names)


def write_review(portfolio: DataFrame, folder: str, names: Iterable[str] = tuple(REVIEW)) -> None:
    """Write each report as CSV under its own name."""
    for name, report in review(portfolio, names).items():
        write_report(report, f"{folder.rstrip('/')}/{name}")


def expectations(
    portfolio: DataFrame, scenario: Scenario = Scenario(), tolerance: float = 1.0
) -> DataFrame:
    """Check a portfolio against what its scenario leads one to expect.

    Medians are no part of the checks, so the band report leaves them out.
    """
    metrics = [m for m in BAND_METRICS if m.kind != "median"]
    targets = {b: 100 * float(getattr(scenario, w)) for b, w in BAND_WEIGHT.items()}
    checks = review_expectations(
        band_mix(portfolio),
        segment_profile(portfolio, "score_band", metrics),
        pti_buckets(portfolio),
        BANDS,
        PTI_LABELS,
        targets,
        tolerance,
    )
    return checks.unionByName(at_limit(portfolio, "estimated_pd", "0.45", 0.25))

"""Parameters of the jobs. The numbers are fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Composite score weights (fixed values), in the order the terms are added.
BATTING_WEIGHTS = {
    "runs": 0.458,
    "average": 0.398,
    "strike_rate": 0.325,
    "fours": 0.406,
    "sixes": 0.417,
    "centuries": 0.432,
}
BOWLING_WEIGHTS = {
    "wickets": 0.428,
    "bowling_average": -0.591,
    "economy_rate": -0.383,
    "bowling_strike_rate": -0.566,
}


@dataclass(frozen=True)
class RoleRule:
    """Below ``min_wickets`` a player is a batsman, else below ``min_runs`` a bowler."""

    min_wickets: int = 50
    min_runs: int = 500


@dataclass(frozen=True)
class MartRule:
    """Eligibility floors of the two ranking marts."""

    min_matches: int = 20
    min_wickets: int = 10


@dataclass(frozen=True)
class GateRule:
    """Volume and completeness thresholds of one Silver table.

    ``fixture_min_rows`` replaces ``min_rows`` when the gate runs on sample files.
    """

    min_rows: int
    max_null_ratio: float = 0.02
    fixture_min_rows: int | None = None

    def __post_init__(self) -> None:
        if not 0 <= self.max_null_ratio <= 1:
            raise ValueError("max_null_ratio must lie in [0, 1]")

    def rows_needed(self, fixtures: bool = False) -> int:
        if fixtures and self.fixture_min_rows is not None:
            return self.fixture_min_rows
        return self.min_rows


@dataclass(frozen=True)
class BattingLimits:
    runs_max: int = 25000
    strike_rate_max: float = 500.0


@dataclass(frozen=True)
class BowlingLimits:
    wickets_max: int = 700
    economy_max: float = 15.0


BATTING_GATE = GateRule(min_rows=2000, fixture_min_rows=50)
BOWLING_GATE = GateRule(min_rows=1500, fixture_min_rows=50)

FIRST_YEAR = 1860
SALT_BUCKETS = 10
RANKING_LIMIT = 25
RANKING_LIMIT_MAX = 200
CODECS = ("snappy", "gzip", "zstd")

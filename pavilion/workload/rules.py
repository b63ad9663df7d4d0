"""Thresholds of the registered queries; the test tables are smaller than real careers."""

from __future__ import annotations

from pavilion.config import MartRule, RoleRule

ROLES = RoleRule(min_wickets=30, min_runs=2000)
RANKED = MartRule(min_matches=10, min_wickets=10)
LAST_YEAR = 2030  # a fixed bound on years, so that the queries mean the same next year

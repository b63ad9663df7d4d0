"""The daily job: Bronze to Silver, quality gate, Gold.

All tables of all layers are written aside and tested there, and then published in one commit
(``sources.commits``), so a failed gate, test or write leaves all tables of the day before as they were.
Rejected rows are published as quarantine tables. Intermediate folders and those of a failed run are deleted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from pavilion.config import GateRule, MartRule, RoleRule
from pavilion.operators import profiles
from pavilion.operators.quality import Contract, contract_checks, quarantine, require_reports, require_tests, sound_document
from pavilion.operators.reshape import flatten_balls, flatten_matches, flatten_weather
from pavilion.plans import conform, marts, staging
from pavilion.plans.contracts import ball_tests, model_tests, silver_ball_tests, silver_contracts, source_tests
from pavilion.schemas import SILVER_BATTING, SILVER_BOWLING
from pavilion.session import discard, materialize, new_folder
from pavilion.sources import commits, tables

_CONFORM = {"batting": conform.conform_batting, "bowling": conform.conform_bowling}
_SILVER = {"batting": SILVER_BATTING, "bowling": SILVER_BOWLING}
Contracts = Mapping[str, tuple[Contract, GateRule]]


@dataclass(frozen=True)
class Layers:
    """Root folders of the layers; ``quarantine`` defaults to a folder beside Silver."""

    bronze: str
    silver: str
    gold: str
    quarantine: str | None = None

    @property
    def rejects(self) -> str:
        return self.quarantine or f"{self.silver.rstrip('/')}_quarantine"

    @property
    def commits(self) -> str:
        """Folder of the manifests, which name the published folders of Silver, Gold and quarantine."""
        return f"{self.silver.rstrip('/')}_commits"


def published(spark: SparkSession, layers: Layers, table: str, schema: T.StructType | None = None, manifest: commits.Manifest | None = None) -> DataFrame:
    """A published table by its path in a layer, such as ``f"{layers.gold}/dim_player"``."""
    return commits.read(spark, layers.commits, table, schema, manifest=manifest)


@dataclass(frozen=True)
class Audit:
    """Row counts of one table's transform; ``quarantined`` rows are part of the dropped ones."""

    table: str
    rows_in: int
    rows_out: int
    quarantined: int = 0

    @property
    def dropped(self) -> int:
        return self.rows_in - self.rows_out


@dataclass(frozen=True)
class Settings:
    """Rules of a run; ``salt_rows`` is the number of rows from which a player counts as hot."""

    contracts: Contracts = field(default_factory=silver_contracts)
    fixtures: bool = False
    roles: RoleRule = RoleRule()
    marts: MartRule = MartRule()
    rain: float | None = None
    salt_rows: int = 1_000_000


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables of one run, deleted when the run ends."""
    folder = new_folder(spark, "daily")
    try:
        yield folder
    finally:
        discard(spark, folder)


def conform_audited(bronze: DataFrame, source: str, root: str, date: dt.date) -> Audit:
    """Conform one Bronze table into its Silver partition, counting rows in the same job."""
    counted, rows_in = tables.audited(bronze, "rows_in")
    silver, rows_out = tables.audited(_CONFORM[source](counted), "rows_out")
    tables.write_partition(silver, root, date)
    return Audit(source, rows_in.get["rows_in"], rows_out.get["rows_out"])


def conform_split(run: commits.Run, bronze: DataFrame, source: str, table: str, rejects: str, date: dt.date, contract: Contract) -> Audit:
    """Conform one Bronze table and split it by the contract, in one scan and one write that also counts."""
    counted, rows_in = tables.audited(bronze, "rows_in")
    conformed = _CONFORM[source](counted)
    checks = contract_checks(contract, conformed)
    verdicts = Observation("verdicts")
    bad = reduce(lambda a, b: a | b, [c.fails for c in checks], F.lit(False))
    judged = conformed.observe(verdicts, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
    run.write_split(table, rejects, judged, checks, date)
    found = verdicts.get
    return Audit(source, rows_in.get["rows_in"], found["n"] - found["bad"], found["bad"])


def bronze_to_silver(run: commits.Run, layers: Layers, date: dt.date, settings: Settings) -> list[Audit]:
    """Conform the day's career tables, profile them and gate them by their profiles.

    Profiles are kept by date; ``table_profile`` adds them up.
    """
    audits, built, reports = [], {}, {}
    for source, schema in _SILVER.items():
        bronze = tables.read_partition(run.spark, tables.table_path(layers.bronze, source), date)
        table, contract = f"{layers.silver}/{source}", settings.contracts[source][0]
        audits.append(conform_split(run, bronze.drop(tables.DATE_COLUMN), source, table, f"{layers.rejects}/{source}", date, contract))
        built[source] = run.read(table, schema, [date]).drop(tables.DATE_COLUMN)
        profiled = run.write(f"{table}_profile", profiles.profile(built[source], contract).coalesce(1), date)
        reports[source] = profiles.profile_report(profiled, built[source].schema, *settings.contracts[source], settings.fixtures)
    require_reports(reports)
    require_tests(built, source_tests())
    return audits


def table_profile(spark: SparkSession, layers: Layers, source: str) -> DataFrame:
    """The profile of a career table over all published dates, from its dates' profiles."""
    return profiles.merged(published(spark, layers, f"{layers.silver}/{source}_profile"))


def documents_to_silver(run: commits.Run, docs: DataFrame, weather: DataFrame | None, layers: Layers, date: dt.date, folder: str) -> list[Audit]:
    """Flatten match and weather documents into full-refresh Silver tables; broken ones go to quarantine.

    Each set is parsed once. Without documents the tables of the last run stay.
    """
    audits = []
    for name, given, build in (
        ("matches", docs, {"matches": flatten_matches, "balls": flatten_balls}),
        ("weather", weather, {"weather": flatten_weather}),
    ):
        if given is None:
            continue
        counted, rows_in = tables.audited(given, "rows_in")
        parsed = materialize(counted, name, folder)
        if tables.CORRUPT in parsed.columns:
            sound, broken = quarantine(parsed, [sound_document()])
            broken, n_broken = tables.audited(broken.select("match_id", tables.CORRUPT, "reasons"), "quarantined")
            run.write(f"{layers.rejects}/{name}", broken, date)
            sound, lost = sound.drop(tables.CORRUPT), n_broken.get["quarantined"]
        else:
            sound, lost = parsed, 0
        total = rows_in.get["rows_in"]
        audits.append(Audit(name, total, total - lost, lost))
        if total > lost:
            for table, flatten in build.items():
                run.write(f"{layers.silver}/{table}", flatten(sound))
    return audits


def silver_tables(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    """The published career tables, both of one run."""
    manifest = commits.published(spark, layers.commits)
    return {name: published(spark, layers, f"{layers.silver}/{name}", schema, manifest) for name, schema in _SILVER.items()}


def silver_to_gold(run: commits.Run, layers: Layers, settings: Settings, folder: str) -> None:
    """Build the career tables of Gold and test them.

    Each table is written before the next reads it, staging included, so nothing
    is computed twice.
    """
    silver = {name: run.read(f"{layers.silver}/{name}", schema) for name, schema in _SILVER.items()}
    wide = marts.player_stats_wide(
        tables.with_row_id(silver["batting"]), silver["bowling"], salt_by=["row_id"], rows_per_task=settings.salt_rows, by=tables.DATE_COLUMN
    )
    staged = {
        "stg_batting": materialize(staging.stg_batting(silver["batting"]), "stg_batting", folder),
        "stg_bowling": materialize(staging.stg_bowling(silver["bowling"]), "stg_bowling", folder),
    }
    sides = staged["stg_batting"], staged["stg_bowling"]

    def gold(name: str, df: DataFrame) -> DataFrame:
        return run.write(f"{layers.gold}/{name}", df)

    built = {"player_stats": gold("player_stats", wide.drop("row_id", tables.DATE_COLUMN))}
    built["dim_player"] = gold("dim_player", marts.dim_player(*sides, settings.roles))
    built["fact_career_stats"] = gold("fact_career_stats", marts.fact_career_stats(*sides))
    for name, build in (("mart_top_batsmen", marts.mart_top_batsmen), ("mart_top_bowlers", marts.mart_top_bowlers)):
        built[name] = gold(name, build(built["dim_player"], settings.marts, folder=folder))
    require_tests(staged | built, model_tests())


def balls_to_gold(run: commits.Run, layers: Layers, settings: Settings) -> None:
    """Build the ball-by-ball dimensions and fact and test them, Silver included."""
    stored = {name: run.read(f"{layers.silver}/{name}") for name in ("matches", "balls", "weather")}
    matches, balls = staging.stg_matches(stored["matches"]), staging.stg_balls(stored["balls"])
    weather = staging.stg_weather(stored["weather"], rain=settings.rain)
    # The keys first: a repeated one multiplies balls in the fact.
    require_tests({"matches": matches, "weather": stored["weather"]}, silver_ball_tests())
    plans = {
        "dim_player_source": marts.dim_player_source(balls),
        "dim_venue": marts.dim_venue(matches),
        "dim_weather": marts.dim_weather(weather),
        "fact_ball_by_ball": marts.fact_ball_by_ball(balls, matches, weather),
    }
    built = {name: run.write(f"{layers.gold}/{name}", df) for name, df in plans.items()}
    require_tests({"matches": matches, **built}, ball_tests())


def run_daily(
    spark: SparkSession,
    layers: Layers,
    date: dt.date,
    settings: Settings | None = None,
    documents: DataFrame | None = None,
    weather: DataFrame | None = None,
    **options: Any,
) -> list[Audit]:
    """The whole day: careers, then, where ``documents`` and ``weather`` are given, ball by ball.

    Documents are frames as ``scan_json_docs`` or ``scan_zip_json`` return them. ``options`` are
    fields of ``Settings``. Tables are read back with ``published``.
    """
    settings = settings or Settings(**options)
    with run_folder(spark) as folder, commits.Run(spark, layers.commits) as run:
        audits = bronze_to_silver(run, layers, date, settings)
        if documents is not None:
            audits += documents_to_silver(run, documents, weather, layers, date, folder)
        silver_to_gold(run, layers, settings, folder)
        if documents is not None and weather is not None:
            balls_to_gold(run, layers, settings)
        run.publish()
    return audits

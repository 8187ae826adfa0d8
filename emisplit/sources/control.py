"""Run control: ``keyword,value`` lines or the process environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emisplit.plans.scenario import SETTINGS, Scenario
from emisplit.plans.tables import Tables
from emisplit.sources.files import load_user_files


def parse_control(lines: DataFrame) -> DataFrame:
    """One row per run from ``(run_name, position, value)`` control lines.

    Of a keyword written twice the first value counts; ``position`` orders the
    lines of a run and may be left out where no keyword repeats. Blank lines, lines starting with ``#`` and unknown keywords are ignored;
    a run that has nothing else is a run without settings.
    The value is the second comma field; anything after it is dropped.
    """
    ends = r"^\s+|\s+$"
    fields = lines.select(
        "run_name",
        F.col("position") if "position" in lines.columns else F.lit(0).alias("position"),
        F.regexp_replace("value", ends, "").alias("line"),
        F.split("value", ",").alias("f"),
    )
    keyword = F.upper(F.regexp_replace(F.col("f")[0], ends, ""))
    settings = fields.select(
        "run_name",
        "position",
        F.when(~F.col("line").startswith("#") & keyword.isin(*SETTINGS), keyword).alias("keyword"),
        F.regexp_replace(F.coalesce(F.get("f", F.lit(1)), F.lit("")), ends, "").alias("dataval"),
    )
    # The first of several values is found by sorting. Lines are dealt out by run before that, so that no task sorts all
    # lines of a large input file, and the settings of a run then need neither another shuffle nor another sort.
    first = settings.repartition("run_name").groupBy("run_name", "keyword").agg(F.min(F.struct("position", "dataval"))["dataval"].alias("dataval"))
    return first.groupBy("run_name").agg(*[F.max(F.when(F.col("keyword") == name, F.col("dataval"))).alias(name) for name in SETTINGS])


def scenario_table(runs: DataFrame) -> DataFrame:
    """The scenario table of parsed control lines, an empty setting being none."""

    def setting(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name))

    upper = {"mechanism": "MECH_BASIS", "aqm": "AQM", "kind": "RUN_TYPE", "outputs": "OUTPUT"}
    columns = [F.upper(setting(name)).alias(column) for column, name in upper.items()]
    columns += [setting(name).alias(name.lower()) for name in ("OUTPUT", "PRO_FILE", "PROC_FILE")]
    return runs.select(F.col("run_name").alias("scenario_id"), *columns)


def scenarios_from(runs: DataFrame) -> list[Scenario]:
    """Scenario objects of a run table; one small row per requested run."""
    return [
        Scenario(row["run_name"], **{k.lower(): row[k] for k in SETTINGS if row[k] is not None})
        for row in runs.orderBy("run_name").collect()
    ]


def read_scenarios(spark: SparkSession, paths: Mapping[str, str]) -> list[Scenario]:
    """Scenarios of control files, by run name."""
    parts = [
        spark.read.text(path, wholetext=True).select(
            F.lit(name.strip()).alias("run_name"), F.posexplode(F.split("value", "\r?\n")).alias("position", "value")
        )
        for name, path in paths.items()
    ]
    return scenarios_from(parse_control(reduce(DataFrame.unionByName, parts)))


def with_user_files(spark: SparkSession, scenario: Scenario, tables: Tables) -> Tables:
    """The tables of a run, with the user files its settings name."""
    named = {
        "toxics": scenario.tox_file,
        "gas_process": scenario.proc_file,
        "primary": scenario.primary_file,
        "user_profile_wts": scenario.pro_file,
    }
    paths = {table: path for table, path in named.items() if path}
    return tables.with_(**load_user_files(spark, paths)) if paths else tables


def scenario_from_environment(run_name: str, environ: Mapping[str, str] | None = None) -> Scenario:
    """The same keywords from environment variables; empty means not set."""
    env = os.environ if environ is None else environ
    found = {k.lower(): env[k].strip() for k in SETTINGS if env.get(k)}
    return Scenario(run_name.strip(), **found)

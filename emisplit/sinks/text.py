"""Fixed-width text and table sinks.

Lines are built on the executors and written in one global order as part
files: reading the parts of a directory by name gives the file. Nothing is
gathered into one task or on the driver.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emisplit.errors import SpeciationError
from emisplit.functions import double, inline_table
from emisplit.plans.scenario import Scenario
from emisplit.plans.speciation import Results
from emisplit.staging import forget, hadoop, moved, observed, subfolders, written

#: Split factors below this are written in scientific notation (fixed value).
SCIENTIFIC_BELOW = 0.0099

#: Order of the lines of one file.
_ORDER = ["section", "key1", "key2", "key3"]

_LINE_COLUMNS = ["scenario_id", *_ORDER, "line"]


def _lines(rows: DataFrame, section: int, line: Column, *keys: str) -> DataFrame:
    padded = [F.col(k) for k in keys] + [F.lit("")] * (3 - len(keys))
    return rows.select(
        "scenario_id",
        F.lit(section).alias("section"),
        *[k.alias(f"key{i}") for i, k in enumerate(padded, 1)],
        line.alias("line"),
    )


def header_lines(metadata: DataFrame, prefix: str = "#") -> DataFrame:
    """Comment lines with the run's settings and source files.

    ``prefix`` starts each keyword; readers that look for a marker of their
    own behind the comment sign pass it here.
    """
    line = F.format_string(
        "%-20s %s %s",
        F.concat(F.lit(prefix), "keyword"),
        F.coalesce("dataval", F.lit("")),
        F.coalesce("version", F.lit("")),
    )
    return _lines(metadata, 0, line, "keyword")


def _as_printed(name: str, scale: int, digits: int) -> Column:
    """Round a decimal to ``digits`` the way C prints the nearest double.

    A value halfway between two printed numbers goes to the side its double
    lies on, or to the even one when the double is exact. The side is the sign
    of ``double * 10**scale - units``, computed without error by splitting the
    double in two halves.
    """
    value = F.col(name)
    units = F.abs(value * F.lit(10**scale)).cast("bigint")
    step = 10 ** (scale - digits)
    rest = units % step
    x = F.abs(double(value))
    power = F.lit(float(10**scale))
    high = x * 134217729.0 - (x * 134217729.0 - x)
    side = (high * power - units.cast("double")) + (x - high) * power
    is_odd = ((units - rest) / F.lit(step)).cast("bigint") % 2 == 1
    half = rest == step // 2
    up = (rest > step // 2) | (half & ((side > 0) | ((side == 0) & is_odd)))
    rounded = units - rest + F.when(up, step).otherwise(0)
    return F.signum(double(value)) * (rounded.cast("double") / power)


def split_lines(splits: DataFrame) -> DataFrame:
    """Split factor rows; small factors in scientific notation."""
    profile = F.coalesce("profile_id", F.lit(""))
    names = (profile, "eminv_poll", "aqm_poll")
    divisor = _as_printed("divisor", 8, 6)

    def small_number(name: str) -> Column:
        """Seven digits: nine decimals from a thousandth on, all ten below."""
        value = double(name)
        return F.when(F.abs(value) >= 0.001, _as_printed(name, 10, 9)).otherwise(value)

    split = double("split_factor")
    plain = F.format_string(
        "%-20s %-20s %-10s %12.6f %12.6f %12.6f",
        *names,
        _as_printed("split_factor", 10, 6),
        divisor,
        _as_printed("mass_fraction", 10, 6),
    )
    small = F.format_string(
        "%-20s %-20s %-10s %.6e %12.6f %.6e",
        *names,
        small_number("split_factor"),
        divisor,
        small_number("mass_fraction"),
    )
    line = F.when(split >= SCIENTIFIC_BELOW, plain).otherwise(small)
    return _lines(splits, 2, line, "profile_id", "eminv_poll", "aqm_poll")


def nhap_lines(header: DataFrame) -> DataFrame:
    """Names the integrated total excludes."""
    line = F.format_string("%-15s %-20s", F.lit("#NHAP NONHAPTOG"), "aqminv_poll")
    return _lines(header, 1, line, "aqminv_poll")


def gspro_lines(results: Results, prefix: str = "#") -> DataFrame:
    lines = split_lines(results.splits)
    if results.header is not None:
        lines = lines.unionByName(nhap_lines(results.header))
    if results.metadata is not None:
        lines = lines.unionByName(header_lines(results.metadata, prefix))
    return lines.select(_LINE_COLUMNS)


def _written(rows: DataFrame, scenarios: tuple[Scenario, ...]) -> DataFrame:
    """Rows of the scenarios whose settings ask for conversion output."""
    asked = [(s.run_name,) for s in scenarios if s.writes_conversions]
    listed = inline_table(rows.sparkSession, asked, "scenario_id string")
    return rows.join(F.broadcast(listed), "scenario_id", "left_semi")


def conversion_lines(conversions: DataFrame) -> DataFrame:
    line = F.format_string(
        "%-20s %-20s %-20s %12.8f ", "from_specie", "to_specie", "profile_id", _as_printed("cnv_factor", 10, 8)
    )
    return _lines(conversions, 2, line, "from_specie", "to_specie", "profile_id")


def gscnv_lines(results: Results, prefix: str = "#") -> DataFrame | None:
    if results.conversions is None:
        return None
    lines = conversion_lines(results.conversions)
    if results.metadata is not None:
        lines = lines.unionByName(header_lines(results.metadata, prefix))
    return _written(lines, results.scenarios).select(_LINE_COLUMNS)


def volatility_lines(classes: DataFrame) -> DataFrame:
    """Tab separated id, name and class."""
    number = F.coalesce(F.col("specie_id").try_cast("bigint").cast("string"), F.col("specie_id"))
    line = F.concat_ws("\t", number, F.coalesce("specie_name", F.lit("")), "voc_class")
    return _lines(classes, 2, line, "specie_id")


def assert_not_empty(rows: DataFrame, what: str) -> DataFrame:
    if rows.isEmpty():
        raise SpeciationError(f"no data to write: {what}")
    return rows


def _roots(spark: SparkSession, path: str, targets: dict[str, str]) -> dict[str, list[str]]:
    """Folder to stage in, and the scenarios whose target is elsewhere: one folder for each file system."""
    system = lambda p: str(hadoop(spark, p)[1].getUri())
    roots: dict[str, list[str]] = {path: []}
    for scenario_id, target in targets.items():
        root = next((r for r in roots if system(r) == system(target)), target)
        roots.setdefault(root, []).append(scenario_id)
    return roots


class LineFiles:
    """Ordered lines of many scenarios, written in one job and moved to their targets by ``commit``.

    A scenario's lines are part files that give the file when read by name. Until ``commit`` no target changes;
    a target takes the place of what was there.
    """

    def __init__(self, lines: DataFrame, path: str, targets: dict[str, str] | None = None):
        self.spark, self.path, self.targets = lines.sparkSession, path, targets or {}
        self.folders, self.data = [], 0
        roots = _roots(self.spark, path, self.targets)
        elsewhere = [(s,) for root, ids in roots.items() if root != path for s in ids]
        for root, ids in roots.items():
            # Usually all targets are in one file system and this is one job.
            listed = elsewhere if root == path else [(s,) for s in ids]
            mine = lines
            if elsewhere:
                names = F.broadcast(inline_table(self.spark, listed, "scenario_id string"))
                mine = lines.join(names, "scenario_id", "left_anti" if root == path else "left_semi")
            self._stage(mine, root)

    def _stage(self, lines: DataFrame, root: str) -> None:
        folder = f"{root.rstrip('/')}/../.staged-{uuid.uuid4().hex}"
        ordered = lines.orderBy("scenario_id", *_ORDER)
        # Counted above the sort, whose sampling reads what is below it twice.
        ordered, seen = observed(ordered, {"data": F.count_if(F.col("section") == 2)})
        ordered.select("scenario_id", "line").write.partitionBy("scenario_id").text(folder)
        self.data += seen.get.get("data") or 0
        self.folders.append(folder)

    def commit(self) -> None:
        for folder in self.folders:
            for name in subfolders(self.spark, folder):
                scenario_id = unquote(name.removeprefix("scenario_id="))
                moved(self.spark, f"{folder}/{name}", self.targets.get(scenario_id, f"{self.path}/{name}"))
        self.drop()

    def drop(self) -> None:
        for folder in self.folders:
            where, system = hadoop(self.spark, folder)
            system.delete(where, True)


def write_lines(lines: DataFrame, path: str, targets: dict[str, str] | None = None) -> None:
    """One ordered directory per scenario: the one ``targets`` names for it, else one below ``path``.

    Lines are written as they come first: the sort reads them up to three times, to sample, to sample uneven parts again, and to sort.
    """
    made, _ = written(lines, "lines")
    LineFiles(made, path, targets).commit()
    forget(made)


def _targets(results: Results, setting: str) -> dict[str, str]:
    return {s.run_name: getattr(s, setting) for s in results.scenarios if getattr(s, setting)}


def write_outputs(results: Results, path: str, prefix: str = "#") -> None:
    """All text files of a set of scenarios, after the gate has passed: all of them or none.

    Results are computed once and the files are written once, to a staging folder next to ``path``; when every kind
    of file has data they are moved to their targets. A scenario's SPLITS_OUT and CNV_OUT name its targets; without them its
    files go to folders below ``path``.
    """
    results = results.written().gate()
    kinds = [("split factors", gspro_lines(results, prefix), "gspro", "splits_out")]
    if any(s.writes_conversions for s in results.scenarios):
        conversions = gscnv_lines(results, prefix)
        if conversions is None:
            raise SpeciationError("no data to write: conversion factors")
        kinds.append(("conversion factors", conversions, "gscnv", "cnv_out"))
        if results.volatility is not None:
            classes = volatility_lines(_written(results.volatility, results.scenarios))
            kinds.append(("volatility classes", classes, "volatility", None))
    staged: list[LineFiles] = []
    try:
        for what, lines, name, setting in kinds:
            staged.append(LineFiles(lines, f"{path}/{name}", _targets(results, setting) if setting else None))
            # Header lines count as data of the splits, as they are written to the file.
            if not staged[-1].data and (name != "gspro" or lines.isEmpty()):
                raise SpeciationError(f"no data to write: {what}")
    except Exception:
        for files in staged:
            files.drop()
        raise
    for files in staged:
        files.commit()


def write_tables(results: Results, path: str) -> None:
    """Split and conversion tables as Parquet, one directory per scenario.

    Only the directories of the scenarios at hand are replaced.
    """
    for name, rows in (("splits", results.splits), ("conversions", results.conversions)):
        if rows is not None:
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("scenario_id")
                .parquet(f"{path}/{name}")
            )

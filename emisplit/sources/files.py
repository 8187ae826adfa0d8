"""File readers built on the line parsers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from emisplit.errors import SpeciationError
from emisplit.functions import inline_table, null_as
from emisplit.schemas import KEYS, METADATA_KEYWORDS, SHARED, schema
from emisplit.sources.lines import (
    PLACE,
    clean_text,
    judged_lines,
    line_numbers,
    missing_values,
    numbered_lines,
    parse_csv,
    parse_invtable,
    parse_plain,
    parse_process_modes,
)
from emisplit.staging import bucketed, forget, observed, published, written

#: Header keys every run starts from (fixed values).
_HEADER_KEYS = ("AQM", "MECH", "RUN_TYPE", "PROCESS")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines split at newline only; a carriage return stays in its line."""
    return spark.read.text(path, lineSep="\n")


def clean_file(spark: SparkSession, source: str, target: str) -> None:
    """Write ``source`` to ``target`` without its unprintable characters."""
    cleaned = read_lines(spark, source).select(clean_text("value").alias("value"))
    cleaned.write.mode("overwrite").text(target)


def read_table(spark: SparkSession, path: str, table: str, *, clean: bool = False) -> DataFrame:
    """One reference table from its text file."""
    lines = read_lines(spark, path)
    if clean:
        lines = lines.select(clean_text("value").alias("value"))
    return parse_invtable(lines) if table == "invtable" else parse_csv(lines, table)


def read_toxics(spark: SparkSession, path: str) -> DataFrame:
    return parse_plain(read_lines(spark, path), "toxics")


def read_process(spark: SparkSession, path: str) -> DataFrame:
    return parse_plain(read_lines(spark, path), "gas_process")


def read_primary(spark: SparkSession, path: str) -> DataFrame:
    return parse_plain(read_lines(spark, path), "primary")


def read_user_weights(spark: SparkSession, path: str) -> DataFrame:
    return parse_plain(read_lines(spark, path), "user_profile_wts")


def read_process_modes(spark: SparkSession, path: str) -> DataFrame:
    """Distinct profile and mode pairs, sorted."""
    return parse_process_modes(read_lines(spark, path)).orderBy("profile_id", "process")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count.

    A NULL key part never equals another one, as in a unique index.
    """
    return rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def _totals(found: DataFrame) -> list[Row]:
    """Number of ``found`` rows and the smallest of them; nothing if there are none."""
    first = F.min(F.struct(*found.columns))
    total = found.agg(F.count("*").alias("findings"), first.alias("first")).first()
    return [Row(findings=total["findings"], **total["first"].asDict())] if total["findings"] else []


def assert_unique(rows: DataFrame, keys: list[str], table: str = "table") -> DataFrame:
    """Return ``rows``, or raise with the number of duplicated keys, the first, and a report of all."""
    found = duplicates(rows, keys)
    if total := _totals(found):
        raise SpeciationError(f"{table}: duplicate key {keys}", total, found)
    return rows


def assert_filled(rows: DataFrame, table: str) -> DataFrame:
    found = missing_values(rows, table)
    if total := _totals(found):
        raise SpeciationError(f"{table}: required value missing", total, found)
    return rows


def recorded_sources(paths: DataFrame) -> DataFrame:
    """``keyword, dataval``: the name recorded for each ``keyword, path``, the path after its first slash or all of it."""
    return paths.select("keyword", F.regexp_replace("path", r"^[^/]*/", "").alias("dataval"))


def load_metadata(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Header keys plus the source file of each recorded table."""
    header = inline_table(spark, [(key, "Not Applicable", None) for key in _HEADER_KEYS], SHARED["metadata"])
    named = [(keyword, paths[table]) for table, keyword in METADATA_KEYWORDS.items() if table in paths]
    sources = recorded_sources(inline_table(spark, named, "keyword string, path string"))
    return header.unionByName(sources.withColumn("version", null_as("string")))


#: Bytes of text that one bucket of a loaded table holds about.
_BUCKET_BYTES = 1 << 26


def _bytes(spark: SparkSession, path: str) -> int:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(system.getContentSummary(found.getPath()).getLength() for found in system.globStatus(where) or [])


def _load_lines(spark: SparkSession, table: str, path: str, *, clean: bool, plain: bool) -> tuple[DataFrame, DataFrame | None]:
    """(the table's good lines as written, what is wrong with it or None).

    Reading, judging and writing are one job. The rows land in sorted buckets by the table's key, so the
    check of the key needs no shuffle.
    """
    lines = numbered_lines(spark.read.text(path, lineSep="\n"))
    if clean:
        lines = lines.withColumn("value", clean_text("value"))
    judged = judged_lines(lines, table, plain=plain)
    keys, fields = KEYS.get(table, []), schema(table).names
    # Counted before bad lines are left out.
    judged, seen = observed(judged, {"bad": F.count("problem")})
    good = judged.where("problem is null").select(*fields)
    if keys:
        loaded, _ = bucketed(good, table, keys, buckets=1 + _bytes(spark, path) // _BUCKET_BYTES)
    else:
        loaded, _ = written(good, table)
    found = []
    if seen.get.get("bad"):
        bad = judged_lines(lines, table, plain=plain).where("problem is not null")
        bad = line_numbers(bad.select("problem", F.col("value").alias("text"), *PLACE), lines)
        found.append(bad.select(F.lit(table).alias("table"), "line", "problem", "text"))
    if keys:
        problem = F.format_string("%s rows with one key", "copies").alias("problem")
        repeated = duplicates(loaded, keys).select(F.lit(table).alias("table"), null_as("long").alias("line"), problem, F.concat_ws(",", *keys).alias("text"))
        if _totals(repeated):
            found.append(repeated)
    return loaded, reduce(DataFrame.unionByName, found) if found else None


def _all_or_nothing(results: dict[str, tuple[DataFrame, DataFrame | None]]) -> dict[str, DataFrame]:
    """The loaded tables, or an error with totals per table and the report of all that is wrong, and no table."""
    wrong = [report for _, report in results.values() if report is not None]
    if not wrong:
        return {table: rows for table, (rows, _) in results.items()}
    report, _ = written(reduce(DataFrame.unionByName, wrong), "load-report")
    first = F.min(F.struct("line", "problem", "text"))
    totals = report.groupBy("table").agg(F.count("*").alias("findings"), first.alias("first")).orderBy("table").collect()
    for rows, _ in results.values():
        forget(rows)
    kinds = ", ".join(f"{r['table']} ({r['findings']})" for r in totals)
    rows = [Row(table=r["table"], findings=r["findings"], **r["first"].asDict()) for r in totals]
    duplicated = any("duplicate" in r["first"]["problem"] or "with one key" in r["first"]["problem"] for r in totals)
    raise SpeciationError(f"nothing loaded{', duplicate key' if duplicated else ''}: {kinds}; the first of each", rows, report)


def load(spark: SparkSession, paths: dict[str, str], *, clean: tuple[str, ...] = (), folder: str | None = None) -> dict[str, DataFrame]:
    """Read and check all reference tables, all or none of them.

    Every table is written to the shared folder while its lines are judged, and its key is checked on what
    was written. If any line of any file is bad or any key repeats, nothing is returned or published: the error has
    totals per table, and its ``report`` lists every finding as ``table, line, problem, text``.
    With ``folder`` the tables are moved there once all have passed, each in a folder of its name, in place of what was there.
    """
    results = {table: _load_lines(spark, table, path, clean=table in clean, plain=False) for table, path in paths.items()}
    tables = _all_or_nothing(results)
    if folder is not None:
        tables = {table: published(rows, f"{folder}/{table}") for table, rows in tables.items()}
    tables["metadata"] = load_metadata(spark, paths)
    return tables


def load_user_files(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The plain files of a run (toxics, processes, primaries, user weights), all or none of them, as ``load`` does."""
    return _all_or_nothing({table: _load_lines(spark, table, path, clean=False, plain=True) for table, path in paths.items()})

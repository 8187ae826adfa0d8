"""Header rows of the output files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emisplit.functions import null_as
from emisplit.plans.scenario import CRITERIA, HAPLIST, VBS

NOT_APPLICABLE = "Not Applicable"

#: Fixed value: the note as readers of the file expect it.
CAMX_NOTE = "PM CAMx CF carries additional POC compound for model performance evaluation"


def _asks(output: str) -> Column:
    """Whether a run's output setting names this one; no setting asks for gas only."""
    named = F.col("outputs").contains(output)
    return F.coalesce(named, F.lit(output == "VOC"))


def _is_camx_ae6() -> Column:
    return F.coalesce((F.col("mechanism") == "AE6") & (F.col("aqm") == "CAMX"), F.lit(False))


def header_values(profiles_source: bool = False) -> Column:
    """What the header says for ``keyword``, from a run's settings and the recorded source file ``dataval``."""
    gas, particulate = _asks("VOC"), _asks("PM")
    kind, pm_kind = F.coalesce("kind", F.lit("")), F.coalesce("kind", F.lit(CRITERIA))
    own_profiles = F.col("pro_file").isNotNull()
    keyword, recorded = F.col("keyword"), F.col("dataval")
    choices = [
        ("AQM", F.lit(True), F.col("aqm")),
        ("MECH", F.lit(True), F.col("mechanism")),
        ("RUN_TYPE", particulate, pm_kind),
        ("RUN_TYPE", gas, F.col("kind")),
        ("GAS_PROFILES", gas & (kind != HAPLIST) & own_profiles, F.col("pro_file")),
        ("GAS_PROFILES", gas & (kind != HAPLIST), recorded),
        ("PROCESS", gas & F.col("proc_file").isNotNull(), F.col("proc_file")),
        ("INVTABLE", F.lit(True), recorded),
        ("PROFILES", F.lit(profiles_source) & ~own_profiles, recorded),
        ("CARBONS", gas, recorded),
        ("VBS_IVOC_FACTORS", gas & (kind == VBS), recorded),
        ("PM_PROFILES", particulate, recorded),
        ("CAMX_FCRS", particulate & _is_camx_ae6(), recorded),
        ("VBS_SVOC_FACTORS", particulate & (pm_kind == VBS), recorded),
        ("STATIC", _asks("STATIC"), recorded),
    ]
    value = F.when(F.lit(False), F.lit(""))
    for name, applies, said in choices:
        value = value.when((keyword == name) & applies, said)
    return value.otherwise(NOT_APPLICABLE)


def metadata_rows(metadata: DataFrame, runs: DataFrame, flags: DataFrame, *, profiles_source: bool = False) -> DataFrame:
    """Keyword and value rows of every run of the scenario table ``runs``.

    Every recorded keyword appears; the ones a run does not use say so. The
    source of the profile weights is among those unless ``profiles_source``
    asks for it. The header has one row per keyword of a fixed list, so each run meets it whole.
    """
    # The recorded keywords travel as one row to the runs.
    recorded = metadata.groupBy(F.lit(0).alias("all")).agg(F.collect_list(F.struct("keyword", "dataval")).alias("header"))
    named = runs.withColumn("all", F.lit(0) * F.length("scenario_id")).join(recorded, "all")
    header = named.select("*", F.inline("header")).select(
        "scenario_id", "keyword", header_values(profiles_source).alias("dataval"), null_as("string").alias("version")
    )
    notes = runs.where(_asks("PM") & _is_camx_ae6()).select("scenario_id", F.lit(CAMX_NOTE).alias("dataval"))
    comments = flags.where("nonsoaflag = 'N'").select("scenario_id", F.substring("comment", 1, 250).alias("dataval"))
    extra = notes.unionByName(comments).select(
        "scenario_id", F.lit("NOTE").alias("keyword"), "dataval", null_as("string").alias("version")
    )
    return header.unionByName(extra)

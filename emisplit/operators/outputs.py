"""Output tables: split factors, conversion factors, metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emisplit.functions import store
from emisplit.operators.mechanism import UNKNOWN, per_scenario

SPLIT_COLUMNS = ["scenario_id", "profile_id", "eminv_poll", "aqm_poll", "split_factor", "divisor", "mass_fraction"]

CONVERSION_COLUMNS = ["scenario_id", "from_specie", "to_specie", "profile_id", "cnv_factor"]


def actox_rows(actox: DataFrame, eminv_poll: str) -> DataFrame:
    """Zero rows for profiles that consist of active toxics."""
    return actox.select(
        "scenario_id",
        "profile_id",
        F.lit(eminv_poll).alias("eminv_poll"),
        F.lit("VOC").alias("aqm_poll"),
        store(F.lit(0), 15, 10).alias("split_factor"),
        store(F.lit(1), 12, 8).alias("divisor"),
        store(F.lit(0), 15, 10).alias("mass_fraction"),
    )


def with_voc_rows(splits: DataFrame, flagged: DataFrame) -> DataFrame:
    """Add an identity row per profile generated in the flagged scenarios.

    The row is emitted next to the profile's first model species. A group has
    one row per model species, so a window over it stays small.
    """
    marked = F.broadcast(flagged.select("scenario_id", F.lit(True).alias("is_flagged")))
    group = Window.partitionBy("profile_id", "scenario_id")
    rows = splits.join(marked, "scenario_id", "left").withColumn("lead", F.min("aqm_poll").over(group))
    own = F.struct(*SPLIT_COLUMNS)
    identity = F.struct(
        "scenario_id",
        "profile_id",
        F.lit("VOC").alias("eminv_poll"),
        F.lit("VOC").alias("aqm_poll"),
        store(F.lit(1), 15, 10).alias("split_factor"),
        store(F.lit(1), 12, 8).alias("divisor"),
        store(F.lit(1), 15, 10).alias("mass_fraction"),
    )
    first = F.col("is_flagged").isNotNull() & (F.col("aqm_poll") == F.col("lead"))
    return rows.select(F.inline(F.when(first, F.array(own, identity)).otherwise(F.array(own))))


def static_rows(static: DataFrame, runs: DataFrame, ids: list[str]) -> DataFrame:
    """Static splits of every model and of the scenario's own model."""
    own = F.broadcast(runs.select("scenario_id", F.col("aqm").alias("aq_model")))
    rows = static.select(
        "profile_id",
        "eminv_poll",
        "aqm_poll",
        store("split_factor", 15, 10).alias("split_factor"),
        store("divisor", 12, 8).alias("divisor"),
        store("mass_fraction", 15, 10).alias("mass_fraction"),
        "aq_model",
    )
    anywhere = rows.where("aq_model is null or aq_model = ' '")
    named = rows.join(own, "aq_model")
    return per_scenario(anywhere, ids).select(SPLIT_COLUMNS).unionByName(named.select(SPLIT_COLUMNS))


def rename_model_species(splits: DataFrame, renames: DataFrame, runs: DataFrame) -> DataFrame:
    """Replace model species names for the scenario's model and mechanism."""
    own = F.broadcast(runs.select("scenario_id", F.col("aqm").alias("aq_model"), "mechanism"))
    names = renames.join(own, ["aq_model", "mechanism"]).select(
        "scenario_id", F.col("eminv_poll").alias("old_poll"), F.col("aqm_poll").alias("new_poll")
    )
    rows = splits.withColumnRenamed("aqm_poll", "old_poll").join(names, ["scenario_id", "old_poll"], "left")
    return rows.withColumn("aqm_poll", F.coalesce("new_poll", "old_poll")).select(SPLIT_COLUMNS)


def drop_unknown(splits: DataFrame, flags: DataFrame) -> DataFrame:
    """Without the non-SOA flag, unknown and non-SOA species are not written."""
    unflagged = F.broadcast(flags.where("nonsoaflag = 'N'").select("scenario_id", F.lit(True).alias("hidden")))
    rows = splits.join(unflagged, "scenario_id", "left")
    hidden = F.col("hidden").isNotNull() & F.col("aqm_poll").isin(UNKNOWN, "NONSOA")
    return rows.where(~hidden).select(SPLIT_COLUMNS)


def gscnv_modes(factors: DataFrame, gas_process: DataFrame, invtable: DataFrame) -> DataFrame:
    """Add ``mode__name`` rows for the processes of each profile.

    The rows are emitted next to the profile's own, so the factors are computed
    once. A profile lists at most as many processes as the inventory has modes.
    """
    modes = invtable.select(F.col("mode").alias("process")).distinct()
    listed = gas_process.join(modes, "process", "left_semi")
    listed = listed.groupBy("profile_id").agg(F.collect_list(F.concat("process", F.lit("__"))).alias("prefixes"))

    def row(prefix: Column) -> Column:
        names = [F.concat(prefix, c).alias(c) for c in ("from_specie", "to_specie")]
        return F.struct("scenario_id", *names, "profile_id", "cnv_factor")

    prefixes = F.concat(F.array(F.lit("")), F.coalesce("prefixes", F.array().cast("array<string>")))
    return factors.join(listed, "profile_id", "left").select(F.inline(F.transform(prefixes, row)))


def profile_count(splits: DataFrame) -> DataFrame:
    """Number of distinct profiles generated per scenario."""
    return splits.groupBy("scenario_id").agg(F.countDistinct("profile_id").alias("profiles"))

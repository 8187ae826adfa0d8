"""Volatility basis set: intermediate and semi-volatile organics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emisplit.functions import carried, store, totals
from emisplit.operators.gas import WEIGHT_COLUMNS

#: Species id of methane (fixed value).
METHANE = "529"

#: Bin columns in order; the number becomes the suffix of the model species.
BINS = ("bin0", "bin1", "bin2", "bin3", "bin4")


def _name_for(aqm: str, kind: str):
    return F.col(f"cmaq_{kind}" if aqm == "CMAQ" else f"camx_{kind}")


def ivoc_names(ivoc_species: DataFrame, aqm: str) -> DataFrame:
    """Intermediate-volatility species of one model."""
    return ivoc_species.where(F.col("aqm") == aqm).select("specie_id", "molwt")


def ivoc_factors(factors: DataFrame, ivoc_species: DataFrame, aqm: str, mw_type) -> DataFrame:
    """Factor per profile with the name and molar mass to insert."""
    masses = ivoc_species.select(F.col("specie_id").alias("ivoc_name"), F.col("molwt").cast(mw_type).alias("ivoc_mw"))
    return (
        factors.select("profile_id", _name_for(aqm, "ivocname").alias("ivoc_name"), "nmogfraction")
        .join(masses, "ivoc_name", "left")
        .select("profile_id", "ivoc_name", "nmogfraction", "ivoc_mw")
    )


def insert_ivoc(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """Move a fraction of the non-methane mass into one new species.

    Factor profiles without weights have no row to extend and stay out.
    """
    other = F.col("specie_id") != METHANE
    summed = totals(
        rows,
        ["profile_id"],
        nmog=(F.sum, F.when(other, F.col("percent"))),
        lead=(F.min, F.col("specie_id")),
    ).join(factors, "profile_id", "left")
    has_factor = F.col("nmogfraction").isNotNull()
    scaled = F.when(
        has_factor & other, store((F.lit(1) - F.col("nmogfraction")) * F.col("percent"), 15, 8)
    ).otherwise(F.col("percent"))
    moved = store(F.col("nmogfraction") * F.coalesce("nmog", F.lit(0)), 15, 8)
    own = F.struct(
        "profile_id", "specie_id", scaled.alias("percent"), *carried(rows, "volatile_mw", "non_voctog", "listed")
    )
    new = F.struct(
        "profile_id",
        F.col("ivoc_name").alias("specie_id"),
        moved.alias("percent"),
        F.col("ivoc_mw").alias("volatile_mw"),
        F.when(F.col("ivoc_mw").isNotNull(), F.lit(False)).alias("non_voctog"),
        *carried(rows, "listed"),
    )
    first = F.col("specie_id") == F.col("lead")
    out = F.when(first & has_factor, F.array(own, new)).otherwise(F.array(own))
    return summed.select(F.inline(out)).select(carried(rows, *WEIGHT_COLUMNS))


def svoc_bins(factors: DataFrame, aqm: str) -> DataFrame:
    """One row per profile and bin with a non-zero fraction."""
    bins = F.array(
        *[
            F.struct(
                F.concat(F.col("name"), F.lit(str(i))).alias("bin_poll"),
                store(column, 17, 10).alias("bin_fraction"),
            )
            for i, column in enumerate(BINS)
        ]
    )
    named = factors.select("profile_id", _name_for(aqm, "svocname").alias("name"), *BINS)
    return named.select("profile_id", F.inline(bins)).where("bin_fraction != 0")


def svoc_splits(fractions: DataFrame, bins: DataFrame, aqm: str) -> DataFrame:
    """Spread primary organics over the volatility bins.

    The sources are removed and their mass goes to the bins of the profile,
    next to the first of them; without bins it is lost. For CAMx the organics
    are one species already; otherwise organic carbon and its non-carbon part
    are added up first. A profile has at most one row per species of the
    mechanism, so the window over it stays small.
    """
    organics = ("POA",) if aqm == "CAMX" else ("PNCOM", "POC")
    is_organic = F.col("aqm_poll").isin(*organics)
    listed = bins.groupBy("profile_id").agg(F.collect_list(F.struct("bin_poll", "bin_fraction")).alias("bins"))
    rows = fractions.join(listed, "profile_id", "left")
    if aqm == "CAMX":
        rows = rows.withColumns({"mass": F.col("fraction"), "spreads": is_organic})
        source = F.col("eminv_poll")
    else:
        group = Window.partitionBy("profile_id", "scenario_id")
        first = F.row_number().over(group.orderBy(~is_organic, "aqm_poll", "fraction")) == 1
        mass = F.sum(F.when(is_organic, F.col("fraction"))).over(group)
        rows = rows.select("*", store(mass, 15, 8).alias("mass"), (is_organic & first).alias("spreads"))
        source = F.lit("PM2_5")

    def row(eminv_poll: Column, aqm_poll: Column, fraction: Column) -> Column:
        return F.struct(
            "scenario_id",
            "profile_id",
            eminv_poll.alias("eminv_poll"),
            aqm_poll.alias("aqm_poll"),
            store(fraction, 17, 10).alias("fraction"),
        )

    own = F.array(row(F.col("eminv_poll"), F.col("aqm_poll"), F.col("fraction")))
    spread = F.transform("bins", lambda b: row(source, b["bin_poll"], F.col("mass") * b["bin_fraction"]))
    return rows.select(F.inline(F.when(F.col("spreads"), spread).when(~is_organic, own)))

"""Gas speciation: profile weights to split factors.

The weights are the large table. Its rows carry what the chain needs
(``WEIGHT_COLUMNS``), and in large profiles the salt that ``emisplit.functions.grouping`` splits them by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.functions import carried, double, store, totals

GAS_TYPES = ("GAS", "GAS-VBS")

WEIGHT_COLUMNS = ["profile_id", "specie_id", "percent", "volatile_mw", "non_voctog", "listed"]

#: What becomes of a row of the input weights: it counts, its species has no valid molar mass, its profile is out of tolerance.
KEPT, NO_MASS, OUTSIDE = "kept", "no mass", "outside"

MODEL_KEYS = ["profile_id", "scenario_id", "aqm_poll"]


def gas_profiles(profiles: DataFrame) -> DataFrame:
    return profiles.where(F.col("profile_type").isin(*GAS_TYPES))


def select_gas(profiles: DataFrame, weights: DataFrame) -> DataFrame:
    """Weights of the gas profiles."""
    listed = gas_profiles(profiles).select("profile_id", F.lit(True).alias("listed"))
    return weights.join(listed, "profile_id").select("profile_id", "specie_id", "percent", "listed")


def select_user_weights(profiles: DataFrame, user_weights: DataFrame) -> DataFrame:
    """User weights; profiles missing from the gas table are kept, unlisted."""
    listed = gas_profiles(profiles).select("profile_id", F.lit(True).alias("listed"))
    return user_weights.join(listed, "profile_id", "left").select(
        "profile_id", "specie_id", "percent", F.coalesce("listed", F.lit(False)).alias("listed")
    )


def raw_weights(weights: DataFrame, species: DataFrame) -> DataFrame:
    """Positive weights of known species, with the species columns in use."""
    known = species.select("specie_id", "volatile_mw", "non_voctog")
    return weights.where("percent > 0").join(known, "specie_id").select(
        "profile_id", "specie_id", store("percent", 15, 8).alias("percent"), "volatile_mw", "non_voctog", "listed"
    )


def in_tolerance(tolerance: float):
    total = double("sum_pct")
    return (total >= 100.0 - tolerance) & (total <= 100.0 + tolerance)


def share_of_100(total: str):
    return store(F.col("percent") / F.col(total) * 100, 15, 8)


def judged(rows: DataFrame, tolerance: float) -> DataFrame:
    """Scale profiles to 100 percent, and tell which rows count.

    ``sum_pct`` is the sum over the profile's species with a valid mass. Only rows that count are scaled:
    those of species without a mass, and of listed profiles out of tolerance, are kept for the reports.
    """
    valid = F.coalesce(F.col("volatile_mw") > 0, F.lit(False))
    summed = totals(rows, ["profile_id"], total=(F.sum, F.when(valid, F.col("percent")))).withColumn("sum_pct", store("total", 12, 8))
    fate = F.when(~valid, NO_MASS).when(in_tolerance(tolerance) | ~F.col("listed"), KEPT).otherwise(OUTSIDE)
    fated = summed.withColumn("fate", fate)
    scaled = F.when(F.col("fate") == KEPT, share_of_100("sum_pct")).otherwise(F.col("percent"))
    return fated.withColumn("percent", scaled).select(carried(rows, *WEIGHT_COLUMNS, "sum_pct", "fate"))


def kept(rows: DataFrame) -> DataFrame:
    """The rows of ``judged`` weights that count."""
    return rows.where(F.col("fate") == KEPT).select(carried(rows, *WEIGHT_COLUMNS))


def judged_sums(rows: DataFrame) -> DataFrame:
    """Sum per profile of ``judged`` weights."""
    valid = rows.where(F.col("fate") != NO_MASS)
    return valid.groupBy("profile_id", "listed").agg(F.max("sum_pct").alias("sum_pct"))


def weight_moles(rows: DataFrame) -> DataFrame:
    """Moles per gram of profile, and each species' share of them."""
    moles = rows.withColumn("moles", store(F.col("percent") / 100 / F.col("volatile_mw"), 15, 8))
    summed = totals(moles, ["profile_id"], total=(F.sum, F.col("moles")))
    share = F.col("moles") / store("total", 12, 8)
    return summed.withColumn("moles_pct", store(share, 15, 8)).drop("total")


def moles_by_species(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Moles of each model species that each chemical species contributes."""
    mass = store(F.col("percent") / 100 * F.col("moles_per_mole"), 24, 18)
    per_gram = mass / F.col("weight_mw")
    per_mole = F.col("moles_pct") * F.col("moles_per_mole")
    weights = rows.withColumnRenamed("volatile_mw", "weight_mw")
    weights = weights.select(carried(rows, "profile_id", "specie_id", "percent", "weight_mw", "moles_pct"))
    return weights.join(mapping, "specie_id").select(
        *MODEL_KEYS,
        "specie_id",
        store(per_gram, 15, 8).alias("moles_per_gram"),
        store(per_mole, 15, 8).alias("moles_per_mole_em"),
        *carried(weights, "gram_per_mole"),
    )


def model_species(by_species: DataFrame) -> DataFrame:
    """Moles per gram and average molar mass of every model species.

    The average weighs the molar mass each species gives the model species by
    its share of the model species' moles.
    """
    summed = totals(
        by_species,
        MODEL_KEYS,
        grams_total=(F.sum, F.col("moles_per_gram")),
        moles_total=(F.sum, F.col("moles_per_mole_em")),
    ).where("grams_total > 0")
    fraction = store(F.col("moles_per_mole_em") / store("moles_total", 15, 8), 15, 8)
    part = store(F.col("gram_per_mole") * fraction, 15, 8)
    return (
        summed.select(*MODEL_KEYS, "grams_total", part.alias("part_mw"))
        .groupBy(*MODEL_KEYS, "grams_total")
        .agg(F.sum("part_mw").alias("avg_mw"))
        .select(
            "scenario_id",
            "profile_id",
            "aqm_poll",
            store("grams_total", 15, 8).alias("moles_per_gram"),
            store("avg_mw", 15, 8).alias("avg_mw"),
        )
    )


def split_columns():
    """Split factor, divisor and mass fraction from moles and molar mass."""
    mass = store(F.col("moles_per_gram") * F.col("avg_mw"), 15, 10)
    return (
        mass.alias("split_factor"),
        store("avg_mw", 12, 8).alias("divisor"),
        mass.alias("mass_fraction"),
    )


def gas_splits(model: DataFrame, eminv_poll: str) -> DataFrame:
    return model.select(
        "scenario_id", "profile_id", F.lit(eminv_poll).alias("eminv_poll"), "aqm_poll", *split_columns()
    )


def conversion_factors(rows: DataFrame, source: str, target: str, *, zero_guard: bool = True) -> DataFrame:
    """Total over non-exempt percent per profile.

    Without any non-exempt species the factor is zero. A zero denominator is
    zero too with ``zero_guard`` and an error without it.
    """
    exempt_free = F.when(~F.col("non_voctog"), F.col("percent"))
    sums = rows.groupBy("profile_id").agg(
        F.sum("percent").alias("tog"), F.sum(exempt_free).alias("voc")
    )
    undefined = F.col("voc").isNull()
    if zero_guard:
        undefined = undefined | (F.col("voc") == 0)
    ratio = store("tog", 15, 8) / store("voc", 15, 8)
    factor = F.when(undefined, F.lit(0)).otherwise(store(ratio, 15, 10))
    return sums.select(
        F.lit(source).alias("from_specie"),
        F.lit(target).alias("to_specie"),
        "profile_id",
        store(factor, 15, 10).alias("cnv_factor"),
    )

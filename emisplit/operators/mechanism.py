"""Run mechanism: which model species each chemical species maps to.

All tables here are keyed by ``scenario_id``, so scenarios that differ only in
their mechanism share one plan. ``runs`` is the small table of the scenarios of
the batch, written by the caller; it is the only side that is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emisplit.functions import null_as, splittable, store

UNKNOWN = "UNK"


#: Stands between the names of a batch's scenarios; no name holds it.
_BETWEEN = "\x1f"


def per_scenario(rows: DataFrame, ids: list[str]) -> DataFrame:
    """Repeat each row for every scenario of the batch.

    The names are one literal, so the plan has the same size for any number of scenarios.
    """
    return rows.select("*", F.explode(F.split(F.lit(_BETWEEN.join(ids)), _BETWEEN)).alias("scenario_id"))


def mechanism_rows(mechanism: DataFrame, runs: DataFrame) -> DataFrame:
    """Mechanism rows of each scenario, zero-mole rows included."""
    named = F.broadcast(runs.select("scenario_id", "mechanism"))
    return mechanism.join(named, "mechanism").select("scenario_id", "specie_id", "aqm_poll", "moles_per_mole")


def carbon_rows(carbons: DataFrame, runs: DataFrame) -> DataFrame:
    """Carbon numbers of each scenario's own mechanism."""
    named = F.broadcast(runs.select("scenario_id", "mechanism"))
    return carbons.join(named, "mechanism").select("scenario_id", "aqm_poll", "num_carbons")


def run_mechanism(mech: DataFrame) -> DataFrame:
    """Rows that contribute: more than zero moles."""
    return mech.where("moles_per_mole > 0").select(
        "scenario_id", "specie_id", "aqm_poll", store("moles_per_mole", 15, 8).alias("moles_per_mole")
    )


def species_carbons(species: DataFrame, mech: DataFrame, carbons: DataFrame, ids: list[str]) -> DataFrame:
    """Carbons per species and scenario, and whether the mechanism maps it.

    A species without a positive carbon sum counts as one carbon. It is
    unmapped when its moles do not add up to more than zero.
    """
    per_mole = mech.join(carbons, ["scenario_id", "aqm_poll"], "left")
    sums = per_mole.groupBy("scenario_id", "specie_id").agg(
        F.sum("moles_per_mole").alias("sum_moles"),
        F.sum(F.col("moles_per_mole") * F.col("num_carbons")).alias("sum_carbons"),
    )
    known = per_scenario(species.select("specie_id", "volatile_mw"), ids)
    return known.join(sums, ["scenario_id", "specie_id"], "left").select(
        "scenario_id",
        "specie_id",
        "volatile_mw",
        store(F.when(F.col("sum_carbons") > 0, F.col("sum_carbons")).otherwise(1), 15, 8).alias("num_carbons"),
        (~F.coalesce(F.col("sum_moles") > 0, F.lit(False))).alias("unmapped"),
    )


def unmapped_species(species_runs: DataFrame) -> DataFrame:
    """Species that the mechanism leaves undefined."""
    return species_runs.where("unmapped").select("scenario_id", "specie_id")


def toxics_carbons(toxics: DataFrame, species_runs: DataFrame, ids: list[str]) -> DataFrame:
    """Carbon number of each toxic, kept to three decimals."""
    known = species_runs.select("scenario_id", "specie_id", "num_carbons")
    return (
        per_scenario(toxics, ids)
        .join(known, ["scenario_id", "specie_id"], "left")
        .withColumn("num_carbons", store("num_carbons", 6, 3))
    )


def aqm_carbons(
    carbons: DataFrame,
    ids: list[str],
    toxics: DataFrame | None = None,
    ivoc_names: DataFrame | None = None,
) -> DataFrame:
    """Carbons per model species and scenario.

    The mechanism's own numbers come first, then toxic names it does not
    define, then the intermediate-volatility names, then the unknown species.
    """
    columns = ["scenario_id", "aqm_poll", "num_carbons"]
    keys = ["scenario_id", "aqm_poll"]
    known = carbons.select(*keys, store("num_carbons", 15, 8).alias("num_carbons"))
    if toxics is not None:
        extra = toxics.groupBy(*keys).agg(store(F.min("num_carbons"), 15, 8).alias("num_carbons"))
        known = known.unionByName(extra.join(known.select(*keys), keys, "left_anti").select(columns))
    if ivoc_names is not None:
        one = store(F.lit(1), 15, 8).alias("num_carbons")
        ivoc = per_scenario(ivoc_names.select(F.col("specie_id").alias("aqm_poll")), ids)
        known = known.unionByName(ivoc.select(*keys, one))
    unknown = per_scenario(carbons.sparkSession.range(0, 1, 1, 1), ids).select(
        "scenario_id", F.lit(UNKNOWN).alias("aqm_poll"), store(F.lit(1), 15, 8).alias("num_carbons")
    )
    defined = known.where(F.col("aqm_poll") == UNKNOWN).select(*keys)
    return known.unionByName(unknown.join(defined, keys, "left_anti").select(columns))


def grams_per_mole(mass: str, model_carbons: str, specie_carbons: str) -> Column:
    """Molar mass of a model species as part of a species, by carbons."""
    return store(F.col(mass) * F.col(model_carbons) / F.col(specie_carbons), 24, 14)


def base_map(species: DataFrame, mech: DataFrame, carbons: DataFrame, ids: list[str]) -> DataFrame:
    """Mapping of the plain mechanism: run rows, unknown rows, molar masses.

    A species meets its mechanism rows in one join and a window over them
    gives its sums; such a group has at most one row per model species. A
    species whose moles do not add up to more than zero goes to the unknown
    model species, mole for mole.
    """
    keys = ["scenario_id", "specie_id"]
    detail = mech.join(carbons.withColumnRenamed("num_carbons", "model_carbons"), ["scenario_id", "aqm_poll"], "left")
    of_unknown = F.broadcast(
        carbons.where(F.col("aqm_poll") == UNKNOWN).select("scenario_id", F.col("num_carbons").alias("unknown_carbons"))
    )
    known = per_scenario(species.select("specie_id", "volatile_mw"), ids).join(of_unknown, "scenario_id", "left")
    group = Window.partitionBy(*keys)
    rows = known.join(detail, keys, "left").select(
        "*",
        F.coalesce(F.sum("moles_per_mole").over(group) > 0, F.lit(False)).alias("mapped"),
        F.sum(F.col("moles_per_mole") * F.col("model_carbons")).over(group).alias("sum_carbons"),
        (F.coalesce("aqm_poll", F.lit("")) == F.min(F.coalesce("aqm_poll", F.lit(""))).over(group)).alias("leads"),
    )
    one = store(F.lit(1), 15, 8)
    rows = rows.withColumns(
        {
            "specie_carbons": store(F.when(F.col("sum_carbons") > 0, F.col("sum_carbons")).otherwise(1), 15, 8),
            "model_carbons": store("model_carbons", 15, 8),
            "unknown_carbons": F.coalesce(store("unknown_carbons", 15, 8), one),
        }
    )

    def entry(poll: Column, moles: Column, model_carbons: str) -> Column:
        grams = grams_per_mole("volatile_mw", model_carbons, "specie_carbons")
        return F.struct(*keys, poll.alias("aqm_poll"), moles.alias("moles_per_mole"), grams.alias("gram_per_mole"))

    own = F.when(
        F.col("moles_per_mole") > 0, entry(F.col("aqm_poll"), store("moles_per_mole", 15, 8), "model_carbons")
    )
    unknown = F.when(~F.col("mapped") & F.col("leads"), entry(F.lit(UNKNOWN), one, "unknown_carbons"))
    return rows.select(F.inline(F.array_compact(F.array(own, unknown))))


_MAP_COLUMNS = ["scenario_id", "specie_id", "aqm_poll", "moles_per_mole", "gram_per_mole"]


def drop_active(mapped: DataFrame, toxics: DataFrame) -> DataFrame:
    """Active toxics lose all their mechanism rows, unknown ones included."""
    active = toxics.where("active = 'A'").select("specie_id").distinct()
    return splittable(mapped.join(active, "specie_id", "left_anti"), "specie_id").select(_MAP_COLUMNS)


def toxics_map(toxics: DataFrame, species_runs: DataFrame, model_carbons: DataFrame, ids: list[str]) -> DataFrame:
    """Active and tracer toxics under their own names, mole for mole."""
    known = species_runs.select(
        "scenario_id", "specie_id", "volatile_mw", F.col("num_carbons").alias("specie_carbons")
    )
    model = model_carbons.select("scenario_id", "aqm_poll", F.col("num_carbons").alias("model_carbons"))
    return (
        per_scenario(toxics.select("specie_id", "aqm_poll"), ids)
        .join(known, ["scenario_id", "specie_id"])
        .join(model, ["scenario_id", "aqm_poll"], "left")
        .withColumn("moles_per_mole", store(F.lit(1), 15, 8))
        .withColumn("gram_per_mole", grams_per_mole("volatile_mw", "model_carbons", "specie_carbons"))
        .select(_MAP_COLUMNS)
    )


def ivoc_map(ivoc_names: DataFrame, ids: list[str]) -> DataFrame:
    """Each intermediate-volatility species maps to itself with one carbon."""
    return per_scenario(ivoc_names, ids).select(
        "scenario_id",
        "specie_id",
        F.col("specie_id").alias("aqm_poll"),
        store(F.lit(1), 15, 8).alias("moles_per_mole"),
        store("molwt", 24, 14).alias("gram_per_mole"),
    )


def scenario_flags(runs: DataFrame, descriptions: DataFrame | None, *, case_insensitive: bool = False) -> DataFrame:
    """The non-SOA flag and comment of each scenario's mechanism.

    The run's mechanism name is upper case and is looked up as is, so a
    description in mixed case is found only with ``case_insensitive``. Of names
    that differ in case only the first in code point order counts: the upper one.
    """
    if descriptions is None:
        return runs.select("scenario_id", null_as("string").alias("nonsoaflag"), null_as("string").alias("comment"))
    name = F.upper("mechanism") if case_insensitive else F.col("mechanism")
    named = descriptions.select(name.alias("mechanism"), "nonsoaflag", "comment")
    if case_insensitive:
        first = F.min_by(F.struct("nonsoaflag", "comment"), "mechanism").alias("first")
        named = descriptions.groupBy(name.alias("name")).agg(first).select(F.col("name").alias("mechanism"), "first.*")
    return runs.join(named, "mechanism", "left").select("scenario_id", "nonsoaflag", "comment")

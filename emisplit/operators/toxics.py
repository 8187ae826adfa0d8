"""Toxics and hazardous pollutants: classification, removal, HAP list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.functions import null_as, splittable, store, totals
from emisplit.operators.gas import share_of_100, split_columns
from emisplit.operators.mechanism import grams_per_mole

HAPLIST_PROFILE = "0000"
NO_INTEGRATE_SUFFIX = "_NOI"


def _hap_rows(invtable: DataFrame) -> DataFrame:
    return invtable.where(F.col("voc").isin("V", "T"))


def inventory_toxics(invtable: DataFrame) -> DataFrame:
    """Species the inventory keeps and models, active or tracer.

    Rows of one species may disagree; active wins.
    """
    modelled = _hap_rows(invtable).where("keep = 'Y' and model = 'Y'")
    kind = F.when(F.col("explicit") == "Y", "A").otherwise("T")
    return modelled.groupBy("specie_id").agg(F.min(kind).alias("active"))


def toxics_of_model(toxics: DataFrame, aqm: str) -> DataFrame:
    return toxics.where(F.col("aqm_model") == aqm).select("specie_id", "aqm_poll")


def classify_toxics(toxics: DataFrame, invtable: DataFrame, aqm: str) -> DataFrame:
    """Toxics of one model with their kind; NULL when the inventory has none."""
    return toxics_of_model(toxics, aqm).join(inventory_toxics(invtable), "specie_id", "left")


def drop_unclassified(classified: DataFrame) -> DataFrame:
    return classified.where("active is not null")


def haps(invtable: DataFrame) -> DataFrame:
    """Species and inventory names of the hazardous pollutants."""
    return _hap_rows(invtable).select("specie_id", "eminv_poll").distinct()


def actox_profiles(rows: DataFrame, toxics: DataFrame) -> DataFrame:
    """Profiles that consist of active toxics entirely."""
    active = splittable(toxics.where("active = 'A'").select("specie_id"), "specie_id")
    sums = rows.join(active, "specie_id").groupBy("profile_id").agg(store(F.sum("percent"), 12, 8).alias("sum_pct"))
    return sums.where("sum_pct >= 100").select("profile_id")


def integrate_weights(rows: DataFrame, hap_species: DataFrame) -> DataFrame:
    """Blank the percent of HAP species and scale the rest to 100.

    HAP rows stay with a NULL percent, so a profile made of HAPs only remains
    visible to the conversion factors.
    """
    listed = splittable(hap_species, "specie_id").select("specie_id", F.lit(True).alias("is_hap"))
    flagged = rows.join(listed, "specie_id", "left")
    rest = flagged.withColumn("percent", F.when(F.col("is_hap").isNull(), F.col("percent"))).drop("is_hap")
    summed = totals(rest, ["profile_id"], total=(F.sum, F.col("percent"))).withColumn("sum_pct", store("total", 12, 8))
    return summed.withColumn("percent", share_of_100("sum_pct")).select(rows.columns)


def nointegrate_weights(rows: DataFrame, hap_species: DataFrame, toxics: DataFrame) -> DataFrame:
    """Remove species that are HAP and active toxic; the rest is not scaled."""
    removed = toxics.where("active = 'A'").select("specie_id").join(hap_species, "specie_id", "left_semi")
    return rows.join(splittable(removed, "specie_id"), "specie_id", "left_anti").select(rows.columns)


def nhap_header(invtable: DataFrame) -> DataFrame:
    """Inventory names that the integrated total excludes, one per row."""
    name = F.when(F.col("mode") == "", F.col("eminv_poll")).otherwise(F.concat("mode", F.lit("__"), "eminv_poll"))
    return _hap_rows(invtable).select("specie_id", name.alias("aqminv_poll"))


def _with_tracer_names(rows: DataFrame) -> DataFrame:
    """A tracer also appears under its non-integrated name."""
    plain = F.col("eminv_poll")
    names = F.when(
        F.col("active") == "T", F.array(plain, F.concat(plain, F.lit(NO_INTEGRATE_SUFFIX)))
    ).otherwise(F.array(plain))
    return rows.withColumn("eminv_poll", F.explode(names)).drop("active")


_HAPLIST = ["scenario_id", "specie_id", "eminv_poll", "aqm_poll", "moles_per_mole"]


def haplist_base(hap_names: DataFrame, run_mech: DataFrame) -> DataFrame:
    return hap_names.join(run_mech, "specie_id").select(_HAPLIST)


def haplist_drop_active(base: DataFrame, toxics: DataFrame, flagged: DataFrame) -> DataFrame:
    """Active toxics lose their mechanism rows in the flagged scenarios.

    ``flagged`` lists scenarios of the batch and is as small as that list.
    """
    active = toxics.where("active = 'A'").select("specie_id", F.lit(True).alias("is_active")).distinct()
    marked = F.broadcast(flagged.select("scenario_id", F.lit(True).alias("is_flagged")))
    rows = base.join(active, "specie_id", "left").join(marked, "scenario_id", "left")
    return rows.where("is_active is null or is_flagged is null").select(_HAPLIST)


def haplist_toxics(hap_names: DataFrame, toxics: DataFrame, primary: DataFrame | None) -> DataFrame:
    """Toxic names of the HAPs, unless a primary entry overwrites the name."""
    named = hap_names.join(toxics, "specie_id")
    if primary is not None:
        overwritten = primary.where("writeflag = 'Y'").select(F.col("aqminv_poll").alias("eminv_poll")).distinct()
        named = named.join(overwritten, "eminv_poll", "left_anti")
    rows = named.select(
        "specie_id", "eminv_poll", "aqm_poll", store(F.lit(1), 15, 8).alias("moles_per_mole"), "active"
    )
    return _with_tracer_names(rows)


def haplist_primary(hap_names: DataFrame, toxics: DataFrame, primary: DataFrame) -> DataFrame:
    """One-to-many rows for HAP names that have a toxic."""
    rows = (
        primary.withColumnRenamed("aqminv_poll", "eminv_poll")
        .join(hap_names, "eminv_poll")
        .join(toxics.select("specie_id", "active"), "specie_id")
        .select(
            "specie_id",
            "eminv_poll",
            F.col("aqm_add").alias("aqm_poll"),
            store("split_factor", 15, 8).alias("moles_per_mole"),
            "active",
        )
    )
    return _with_tracer_names(rows)


def own_mass_names(toxics: DataFrame, primary: DataFrame | None) -> DataFrame:
    """Model species that keep the molar mass of the pollutant itself."""
    names = toxics.select("aqm_poll")
    if primary is not None:
        names = names.unionByName(primary.select(F.col("aqm_add").alias("aqm_poll")))
    return names.distinct()


def haplist_masses(
    rows: DataFrame, species_runs: DataFrame, model_carbons: DataFrame, own_mass: DataFrame
) -> DataFrame:
    """Moles per gram and molar mass of every HAP list row."""
    known = species_runs.select(
        "scenario_id", "specie_id", "volatile_mw", F.col("num_carbons").alias("specie_carbons")
    )
    model = model_carbons.select("scenario_id", "aqm_poll", F.col("num_carbons").alias("model_carbons"))
    mass = F.col("volatile_mw")
    scaled = grams_per_mole("volatile_mw", "model_carbons", "specie_carbons")
    return (
        rows.join(known, ["scenario_id", "specie_id"], "left")
        .join(model, ["scenario_id", "aqm_poll"], "left")
        .join(own_mass.withColumn("own_mass", F.lit(True)), "aqm_poll", "left")
        .select(
            *_HAPLIST,
            F.lit(HAPLIST_PROFILE).alias("profile_id"),
            store(F.col("moles_per_mole") / mass, 15, 8).alias("moles_per_gram"),
            F.when(F.col("own_mass"), store(mass, 15, 8)).otherwise(store(scaled, 15, 8)).alias("avg_mw"),
        )
    )


def haplist_splits(masses: DataFrame) -> DataFrame:
    return masses.select("scenario_id", "profile_id", "eminv_poll", "aqm_poll", *split_columns())


def no_toxics(species: DataFrame) -> DataFrame:
    """An empty toxics list, for runs without a toxics file."""
    return species.where(F.lit(False)).select(
        "specie_id", null_as("string").alias("aqm_poll"), null_as("string").alias("active")
    )

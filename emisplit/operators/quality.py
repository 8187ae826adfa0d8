"""Checks and reports. Every finding is a row of one report layout.

Errors stop a run when its gate is asked (``emisplit.plans.speciation``);
warnings only describe what the plans drop or replace.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emisplit.functions import null_as, splittable
from emisplit.operators.mechanism import per_scenario
from emisplit.operators.pm import VBS_TYPE, is_over_100
from emisplit.operators.vbs import BINS

ERROR = "ERROR"
WARNING = "WARNING"

REPORT_COLUMNS = [
    "scenario_id", "severity", "check", "profile_id", "specie_id", "aqm_poll", "value", "message",
]

#: Longest inventory name that still fits after a mode prefix and a suffix
#: (fixed values): toxic with mode, other with mode, toxic without mode.
NAME_LIMITS = (7, 11, 12)


def finding(rows: DataFrame, severity: str, check: str, message: Column | str, value: Column | None = None) -> DataFrame:
    """Rows of a violated check in the report layout."""

    def column(name: str) -> Column:
        return (F.col(name) if name in rows.columns else null_as("string")).alias(name)

    text = F.lit(message) if isinstance(message, str) else message
    return rows.select(
        column("scenario_id"),
        F.lit(severity).alias("severity"),
        F.lit(check).alias("check"),
        column("profile_id"),
        column("specie_id"),
        column("aqm_poll"),
        (null_as("double") if value is None else value.cast("double")).alias("value"),
        text.alias("message"),
    )


def union_findings(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing_settings(runs: DataFrame) -> DataFrame:
    """Settings that the output of a run of the scenario table needs and that it lacks."""
    output = F.coalesce("output", F.lit(""))

    def lacks(setting: str, column: str, outputs: Column) -> Column:
        return F.struct(F.lit(setting).alias("setting"), (F.col(column).isNull() & outputs).alias("lacks"))

    needed = F.array(
        lacks("AQM", "aqm", F.lit(True)),
        lacks("MECH_BASIS", "mechanism", output.isin("", "VOC", "PM")),
        lacks("RUN_TYPE", "kind", output.isin("", "VOC")),
    )
    return runs.select("scenario_id", F.inline(needed)).where("lacks").select("scenario_id", "setting")


def check_required(runs: DataFrame) -> DataFrame:
    message = F.concat(F.lit("not set: "), "setting")
    return finding(missing_settings(runs), ERROR, "required_setting", message)


def unsupported_pm_runs(runs: DataFrame) -> DataFrame:
    """Runs with particulate output whose run type has none."""
    wrong = F.coalesce(~F.col("kind").isin("CRITERIA", "VBS"), F.lit(True))
    return runs.where(F.col("outputs").contains("PM") & wrong).select("scenario_id", "kind")


def check_pm_run_type(runs: DataFrame) -> DataFrame:
    message = F.concat_ws(" ", F.lit("no particulate output for RUN_TYPE"), "kind")
    return finding(unsupported_pm_runs(runs), ERROR, "pm_run_type", message)


def empty_outputs(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Runs of the scenario table that ``rows`` has nothing for."""
    # Without a shuffle of its own an aggregated side would keep a hot run whole.
    present = splittable(rows.select("scenario_id").distinct(), "scenario_id")
    return runs.select("scenario_id").join(present, "scenario_id", "left_anti")


def long_names(invtable: DataFrame, *, pm: bool = False, limits: tuple[int, int, int] = NAME_LIMITS) -> DataFrame:
    """Inventory names that would exceed the width of an output name.

    The particulate variant tests the first case on the other pollutants. A
    missing mode or VOC flag matches no case.
    """
    toxic = F.col("voc").isin("V", "T")
    with_mode = F.col("mode") != ""
    modelled = F.col("model") == "Y"
    width = F.length("eminv_poll")
    first = (~toxic if pm else toxic) & with_mode & modelled & (width > limits[0])
    second = ~toxic & with_mode & (width > limits[1])
    third = toxic & modelled & (width > limits[2])
    return invtable.where(first | second | third).select("eminv_poll").distinct()


def check_name_width(invtable: DataFrame, ids: list[str], *, pm: bool = False) -> DataFrame:
    names = per_scenario(long_names(invtable, pm=pm), ids)
    message = F.concat(F.lit("inventory name too long for an output name: "), "eminv_poll")
    return finding(names, ERROR, "name_width_pm" if pm else "name_width_gas", message)


def uncovered_toxics(inventory_toxics: DataFrame, toxics: DataFrame) -> DataFrame:
    """Inventory toxics that the toxics list of the model lacks."""
    return inventory_toxics.join(toxics, "specie_id", "left_anti").select("specie_id")


def check_toxics_cover(inventory_toxics: DataFrame, toxics: DataFrame, ids: list[str]) -> DataFrame:
    missing = per_scenario(uncovered_toxics(inventory_toxics, toxics), ids)
    return finding(missing, ERROR, "toxics_cover", "active or tracer inventory species missing from the toxics list")


def report_unclassified_toxics(classified: DataFrame, ids: list[str]) -> DataFrame:
    dropped = per_scenario(classified.where("active is null"), ids)
    return finding(dropped, WARNING, "unclassified_toxics", "toxic dropped: neither active nor tracer")


def invalid_hap_mw(hap_species: DataFrame, toxics: DataFrame, species: DataFrame) -> DataFrame:
    """HAP or toxic species without a positive molar mass."""
    used = hap_species.select("specie_id").unionByName(toxics.select("specie_id")).distinct()
    bad = species.where("volatile_mw is null or volatile_mw <= 0").select("specie_id", "volatile_mw")
    return bad.join(used, "specie_id", "left_semi")


def check_hap_mw(hap_species: DataFrame, toxics: DataFrame, species: DataFrame, ids: list[str]) -> DataFrame:
    bad = per_scenario(invalid_hap_mw(hap_species, toxics, species), ids)
    return finding(bad, ERROR, "hap_molecular_weight", "HAP or toxic with invalid molecular weight", F.col("volatile_mw"))


def missing_carbons(mech: DataFrame, carbons: DataFrame) -> DataFrame:
    """Model species of the mechanism without a carbon number."""
    used = mech.select("scenario_id", "aqm_poll").distinct()
    return used.join(carbons, ["scenario_id", "aqm_poll"], "left_anti")


def check_carbons(mech: DataFrame, carbons: DataFrame) -> DataFrame:
    return finding(missing_carbons(mech, carbons), ERROR, "carbons", "model species without carbon number")


def report_unmapped(unmapped: DataFrame) -> DataFrame:
    return finding(unmapped, WARNING, "unmapped_species", "mechanism undefined; set to UNK if referenced")


def unmapped_in_profiles(weights: DataFrame, unmapped: DataFrame, species: DataFrame) -> DataFrame:
    """Unmapped species that surviving profiles use, with their names."""
    used = unmapped.join(weights.select("specie_id").distinct(), "specie_id", "left_semi")
    return used.join(species.select("specie_id", "specie_name"), "specie_id", "left").select(
        "scenario_id", "specie_id", "specie_name"
    )


def report_unmapped_in_profiles(weights: DataFrame, unmapped: DataFrame, species: DataFrame) -> DataFrame:
    rows = unmapped_in_profiles(weights, unmapped, species)
    message = F.concat_ws(" ", F.lit("mechanism undefined, used by profiles:"), "specie_name")
    return finding(rows, WARNING, "unmapped_in_profiles", message)


def report_missing_mw(dropped: DataFrame, ids: list[str]) -> DataFrame:
    return finding(
        per_scenario(dropped, ids), WARNING, "missing_mw", "component dropped: no molecular weight", F.col("percent")
    )


def out_of_tolerance(sums: DataFrame, profiles: DataFrame, tolerance: float) -> DataFrame:
    """Dropped profiles with their sum and shortened name."""
    total = F.col("sum_pct").cast("double")
    named = profiles.select("profile_id", F.substring("profile_name", 1, 50).alias("profile_name"))
    outside = sums.where((total > 100.0 + tolerance) | (total < 100.0 - tolerance))
    return outside.join(named, "profile_id").select("profile_id", "sum_pct", "profile_name")


def report_tolerance(sums: DataFrame, profiles: DataFrame, tolerance: float, ids: list[str]) -> DataFrame:
    rows = per_scenario(out_of_tolerance(sums, profiles, tolerance), ids)
    message = F.concat_ws(" ", F.lit("profile dropped: total percent out of tolerance"), "profile_name")
    return finding(rows, WARNING, "tolerance", message, F.col("sum_pct"))


def computed_species_count(pm_mechanism: DataFrame, runs: DataFrame) -> DataFrame:
    """Number of computed pollutants per scenario's mechanism."""
    computed = pm_mechanism.where("compute and aqm_poll is not null and (specie_id is null or specie_id = '')")
    return (
        runs.select("scenario_id", "mechanism")
        .join(computed.select("mechanism", F.lit(1).alias("one")), "mechanism", "left")
        .groupBy("scenario_id")
        .agg(F.count("one").alias("computed"))
    )


def check_pm_mechanism(pm_mechanism: DataFrame, runs: DataFrame) -> DataFrame:
    wrong = computed_species_count(pm_mechanism, runs).where("computed <> 1")
    return finding(wrong, ERROR, "pm_mechanism", "mechanism needs exactly one computed pollutant", F.col("computed"))


def unknown_pm_species(mech: DataFrame, species: DataFrame) -> DataFrame:
    return mech.join(species, "specie_id", "left_anti")


def check_pm_species(mech: DataFrame, species: DataFrame) -> DataFrame:
    return finding(unknown_pm_species(mech, species), ERROR, "pm_species", "mechanism species missing from species table")


def over_100(weights: DataFrame) -> DataFrame:
    """Profiles whose mechanism species add up to 101 percent or more."""
    return weights.where(is_over_100()).select("scenario_id", "profile_id", "sum_pct").distinct()


def report_over_100(weights: DataFrame, profiles: DataFrame) -> DataFrame:
    named = profiles.select("profile_id", F.substring("profile_name", 1, 50).alias("profile_name"))
    rows = over_100(weights).join(named, "profile_id")
    message = F.concat_ws(" ", F.lit("profile dropped: more than 100 percent"), "profile_name")
    return finding(rows, WARNING, "pm_over_100", message, F.col("sum_pct"))


def negative_components(weights: DataFrame, filled: DataFrame) -> DataFrame:
    """Negative components of profiles that passed the 100 percent test."""
    passed = weights.where(~is_over_100()).select("scenario_id", "profile_id").distinct()
    return filled.where("percent < 0").join(passed, "profile_id").select(
        "scenario_id", "profile_id", "specie_id", "percent"
    )


def report_negative(weights: DataFrame, filled: DataFrame, profiles: DataFrame) -> DataFrame:
    named = profiles.select("profile_id", F.substring("profile_name", 1, 50).alias("profile_name"))
    rows = negative_components(weights, filled).join(named, "profile_id")
    message = F.concat_ws(" ", F.lit("profile dropped: negative component"), "profile_name")
    return finding(rows, WARNING, "pm_negative", message, F.col("percent"))


def uncovered_svoc(profiles: DataFrame, factors: DataFrame) -> DataFrame:
    """Particulate profiles of any size without volatility factors."""
    return profiles.join(factors, "profile_id", "left_anti").select("profile_id", "profile_type")


def check_svoc_cover(profiles: DataFrame, factors: DataFrame, runs: DataFrame) -> DataFrame:
    """The volatility-basis-set type only counts for its own mechanism."""
    own = F.broadcast(runs.select("scenario_id", "takes_vbs"))
    kind = (F.col("profile_type") == VBS_TYPE).alias("is_vbs")
    missing = uncovered_svoc(profiles, factors).select("profile_id", kind)
    takes = F.explode(F.when(F.col("is_vbs"), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False))))
    rows = missing.select("profile_id", takes.alias("takes_vbs")).join(own, "takes_vbs")
    return finding(rows, ERROR, "svoc_cover", "profile missing from the volatility factors")


def bad_svoc_sums(factors: DataFrame) -> DataFrame:
    """Factor rows whose bins do not add up to exactly one."""
    total = reduce(Column.__add__, [F.col(b) for b in BINS])
    return factors.select("profile_id", total.alias("bin_sum")).where("bin_sum != 1")


def check_svoc_sums(factors: DataFrame, ids: list[str]) -> DataFrame:
    rows = per_scenario(bad_svoc_sums(factors), ids)
    return finding(rows, ERROR, "svoc_sum", "volatility bins do not add up to one", F.col("bin_sum"))


def duplicate_keys(rows: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Key combinations that occur more than once, as findings."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
    message = F.concat_ws(" ", F.lit("duplicate key:"), *keys)
    return finding(found, ERROR, check, message, F.col("copies"))


def report_ignored_toxics(toxics: DataFrame, ids: list[str]) -> DataFrame:
    """Runs without HAP processing do not use a toxics list."""
    rows = per_scenario(toxics.select("specie_id", "aqm_poll"), ids)
    return finding(rows, WARNING, "ignored_toxics", "toxics are not used by this run type")


def report_ivoc_without_weights(factors: DataFrame, weights: DataFrame, ids: list[str]) -> DataFrame:
    unused = factors.select("profile_id").join(weights.select("profile_id").distinct(), "profile_id", "left_anti")
    return finding(per_scenario(unused, ids), WARNING, "ivoc_without_weights", "factor profile has no weights")

"""Queries over the test tables, and the SQL to compare them with.

``entry`` is the flagship query, ``queries`` has one entry per operator family
and ``oracle_sql`` the statement for DuckDB under the same name.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from emisplit import Scenario, SpeciationError, Tables, bridge  # noqa: E402
from emisplit.functions import inline_table  # noqa: E402
from emisplit.operators import gas, mechanism, pm, quality, toxics, vbs  # noqa: E402
from emisplit.operators.volatility import volatility_class  # noqa: E402
from emisplit.plans.metadata import metadata_rows  # noqa: E402
from emisplit.plans.speciation import Batch, GasPlan, PmPlan, Results, run_scenarios  # noqa: E402
from emisplit.session import tune  # noqa: E402
from emisplit.sinks.text import gscnv_lines, gspro_lines, volatility_lines, write_lines  # noqa: E402
from emisplit.sources import control, files, lines  # noqa: E402
from emisplit.staging import new_folder  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

def _doubles(rows: DataFrame, *names: str) -> DataFrame:
    """Fixed-point columns as doubles, for comparison."""
    return rows.withColumns({name: F.col(name).cast("double") for name in names})


def _splits(rows: DataFrame) -> DataFrame:
    return _doubles(rows, "split_factor", "divisor", "mass_fraction")


# ---------------------------------------------------------------- scenarios


def _scenario(name: str, kind: str = "CRITERIA", mech: str = "M_A", aqm: str = "CMAQ", output: str = "VOC", **more):
    return Scenario(name, mech_basis=mech, run_type=kind, aqm=aqm, output=output, **more)


def _gas_plan(spark: SparkSession, sf_dir: str, scenario: Scenario, **tables) -> GasPlan:
    inputs = bridge.gas_tables(spark, sf_dir).with_(**tables)
    return GasPlan(Batch(tune(spark), (scenario,), inputs))


def _pm_plan(spark: SparkSession, sf_dir: str, scenario: Scenario) -> PmPlan:
    return PmPlan(Batch(tune(spark), (scenario,), bridge.pm_tables(spark, sf_dir)))


def _hap_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"toxics": bridge.toxics(spark, sf_dir), "primary": bridge.primary(spark, sf_dir)}


def _crit(spark: SparkSession, sf_dir: str, **tables) -> GasPlan:
    return _gas_plan(spark, sf_dir, _scenario("crit"), **tables)


def _hap_plan(spark: SparkSession, sf_dir: str, name: str) -> GasPlan:
    return _gas_plan(spark, sf_dir, _scenario(name, name.upper()), **_hap_tables(spark, sf_dir))


def _run(spark: SparkSession, scenario: Scenario, tables: Tables) -> Results:
    return run_scenarios(tune(spark), [(scenario, tables)], with_report=False)


def _conversions(rows: DataFrame) -> DataFrame:
    return _doubles(rows.drop("scenario_id"), "cnv_factor")


# ---------------------------------------------------------------- gas


def gas_renormalised_weights(spark, sf_dir):
    rows = _crit(spark, sf_dir).normalised_weights()
    return _doubles(rows.select("profile_id", "specie_id", "percent"), "percent")


def gas_unmapped_species(spark, sf_dir):
    return mechanism.unmapped_species(_crit(spark, sf_dir).species_runs())


def gas_species_carbons(spark, sf_dir):
    rows = _crit(spark, sf_dir).species_runs()
    return rows.select("scenario_id", "specie_id", F.col("num_carbons").cast("double").alias("num_carbons"))


def gas_moles_per_gram(spark, sf_dir):
    rows = _crit(spark, sf_dir).moles_by_species()
    columns = ["scenario_id", "profile_id", "specie_id", "aqm_poll", "moles_per_gram", "moles_per_mole_em"]
    return _doubles(rows.select(columns), "moles_per_gram", "moles_per_mole_em")


def gas_model_species(spark, sf_dir):
    return _doubles(_crit(spark, sf_dir).model_species(), "moles_per_gram", "avg_mw")


def gas_split_factors(spark, sf_dir):
    return _splits(_crit(spark, sf_dir).splits())


def gas_user_weights_splits(spark, sf_dir):
    """User weights over suppliers, most of them unknown as profiles."""
    # Dealt out before they are added up: a map task need not hold the pairs of all lines it reads.
    lines = bridge.read(tune(spark), sf_dir, "lineitem").repartition("l_suppkey", "l_partkey")
    weights = lines.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity")).select(
        F.col("l_suppkey").cast("string").alias("profile_id"),
        F.col("l_partkey").cast("string").alias("specie_id"),
        F.round(F.col("quantity") / 10, 6).cast("decimal(10,6)").alias("percent"),
    )
    tables = bridge.gas_tables(spark, sf_dir).with_(user_profile_wts=weights)
    scenario = _scenario("user", mech="M_B", tolerance="10", pro_file="user.csv")
    return _splits(_run(spark, scenario, tables).splits)


def gas_voc_to_tog(spark, sf_dir):
    return _conversions(_crit(spark, sf_dir).conversions())


def gas_voc_to_tog_modes(spark, sf_dir):
    return _conversions(_crit(spark, sf_dir, gas_process=bridge.gas_process(spark, sf_dir)).conversions())


def gas_integrate_splits(spark, sf_dir):
    return _splits(_hap_plan(spark, sf_dir, "integrate").splits())


def gas_integrate_cnv(spark, sf_dir):
    return _conversions(_hap_plan(spark, sf_dir, "integrate").conversions())


def gas_integrate_header(spark, sf_dir):
    return _hap_plan(spark, sf_dir, "integrate").header().select("scenario_id", "aqminv_poll")


def gas_actox_profiles(spark, sf_dir):
    return _hap_plan(spark, sf_dir, "integrate").actox_profiles()


def gas_nointegrate_splits(spark, sf_dir):
    return _splits(_hap_plan(spark, sf_dir, "nointegrate").splits())


def haplist_splits(spark, sf_dir):
    return _splits(_hap_plan(spark, sf_dir, "haplist").splits())


def _vbs_plan(spark, sf_dir):
    return _gas_plan(spark, sf_dir, _scenario("vbs", "VBS"))


def gas_vbs_splits(spark, sf_dir):
    return _splits(_vbs_plan(spark, sf_dir).splits())


def gas_vbs_voc_to_tog(spark, sf_dir):
    return _conversions(_vbs_plan(spark, sf_dir).conversions())


def volatility(spark, sf_dir):
    return volatility_class(bridge.species(tune(spark), sf_dir))


# ---------------------------------------------------------------- particulates


def _pm_scenario(name: str, mech: str = "AE6", aqm: str = "CMAQ", kind: str = "CRITERIA") -> Scenario:
    return _scenario(name, kind, mech, aqm, "PM")


def pm_gap_filled_weights(spark, sf_dir):
    return _doubles(_pm_plan(spark, sf_dir, _pm_scenario("ae6")).gap_filled_weights(), "percent")


def _pm_query(scenario: Scenario) -> Query:
    return lambda spark, sf_dir: _splits(_pm_plan(spark, sf_dir, scenario).splits())


def pm_svoc_bins(spark, sf_dir):
    rows = vbs.svoc_bins(bridge.vbs_svoc_factors(tune(spark), sf_dir), "CMAQ")
    return rows.withColumn("bin_fraction", F.col("bin_fraction").cast("double"))


# ---------------------------------------------------------------- outputs


def static_renamed_splits(spark, sf_dir):
    tables = bridge.gas_tables(spark, sf_dir).with_(
        static=bridge.static(spark, sf_dir), rename_species=bridge.rename_species(spark)
    )
    return _splits(_run(spark, _scenario("static", output="VOC,STATIC"), tables).splits)


def profile_summary(spark, sf_dir):
    return _run(spark, _scenario("crit"), bridge.gas_tables(spark, sf_dir)).summary()


def multi_scenario_splits(spark, sf_dir):
    tune(spark)
    plain = bridge.gas_tables(spark, sf_dir)
    integrated = plain.with_(**_hap_tables(spark, sf_dir))
    particulates = bridge.pm_tables(spark, sf_dir)
    runs = [
        (_scenario("crit"), plain),
        (_scenario("flagless", mech="M_B"), plain),
        (_scenario("nointegrate", "NOINTEGRATE"), integrated),
        (_pm_scenario("ae6"), particulates),
        (_pm_scenario("ae8", "AE8"), particulates),
    ]
    return _splits(run_scenarios(spark, runs, with_report=False).splits)


def _integrate_results(spark: SparkSession, sf_dir: str) -> Results:
    tables = bridge.gas_tables(spark, sf_dir).with_(metadata=bridge.metadata(spark), **_hap_tables(spark, sf_dir))
    return _run(spark, _scenario("integrate", "INTEGRATE"), tables)


def gspro_text(spark, sf_dir):
    return gspro_lines(_integrate_results(spark, sf_dir)).select("scenario_id", "section", "line")


def gscnv_text(spark, sf_dir):
    return gscnv_lines(_integrate_results(spark, sf_dir)).select("scenario_id", "section", "line")


def volatility_text(spark, sf_dir):
    classes = volatility(spark, sf_dir).withColumn("scenario_id", F.lit("all"))
    return volatility_lines(classes).select("line")


# ---------------------------------------------------------------- sources


def clean_text(spark, sf_dir):
    return bridge.read(spark, sf_dir, "documents").select("doc_id", lines.clean_text("text").alias("clean"))


def process_modes(spark, sf_dir):
    return lines.parse_process_modes(bridge.process_lines(spark, sf_dir))


def invtable_lines(spark, sf_dir):
    parsed = lines.parse_invtable(bridge.invtable_lines(spark, sf_dir))
    return parsed.select("eminv_poll", "mode", "specie_id", "keep", "voc", "model", "explicit")


def csv_weights(spark, sf_dir):
    """Weights written as quoted text lines and parsed back."""
    parsed = lines.parse_csv(_weight_lines(spark, sf_dir), "profile_weights")
    return parsed.select("profile_id", "specie_id", F.col("percent").cast("double").alias("percent"))


def plain_process(spark, sf_dir):
    return lines.parse_plain(bridge.csv_lines(bridge.gas_process(spark, sf_dir)), "gas_process")


def duplicate_weights(spark, sf_dir):
    rows = bridge.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("profile_id"), F.col("l_partkey").cast("string").alias("specie_id")
    )
    return files.duplicates(rows, ["profile_id", "specie_id"])


def control_runs(spark, sf_dir):
    """Control lines of one run per customer; of a repeated keyword the first value counts."""
    written = F.array(
        F.lit("# settings"),
        F.concat(F.lit("mech_basis,M_"), F.substring("c_mktsegment", 1, 1)),
        F.lit("  Run_Type , CRITERIA "),
        F.lit(""),
        F.lit("unknown,1"),
        F.concat(F.lit("tolerance,"), F.col("c_nationkey").cast("string"), F.lit(",percent")),
        F.lit("AQM,CMAQ"),
        F.lit("tolerance,1"),
        F.lit("AQM,CAMX"),
    )
    rows = bridge.read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("run_name"), F.posexplode(written).alias("position", "value")
    )
    runs = control.parse_control(rows)
    return runs.select(
        "run_name",
        F.upper("MECH_BASIS").alias("mechanism"),
        F.col("RUN_TYPE").alias("run_type"),
        F.col("AQM").alias("aqm"),
        F.col("TOLERANCE").alias("tolerance"),
    )


def _weight_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = [F.lit("0.5").alias("uncertainty")]
    rest += [F.lit("x, y").alias(c) for c in ("unc_method", "analytic_method", "include_in_sum")]
    rows = bridge.gas_weights(tune(spark), sf_dir).select("profile_id", "specie_id", "percent", *rest)
    return bridge.csv_lines(rows)


def _text_files(lines: DataFrame, name: str) -> str:
    path = new_folder(lines.sparkSession, name)
    lines.write.text(path)
    return path


def loaded_weights(spark, sf_dir):
    """Weights written as text files and loaded from there with all checks."""
    path = _text_files(_weight_lines(spark, sf_dir), "weights")
    rows = files.load(spark, {"profile_weights": path})["profile_weights"]
    return rows.select("profile_id", "specie_id", F.col("percent").cast("double").alias("percent"))


def load_report(spark, sf_dir):
    """Everything that keeps faulty weight files from being loaded. The number of a line depends on how files were cut."""
    path = _text_files(bridge.faulty_weight_lines(tune(spark), sf_dir), "faulty")
    try:
        files.load(spark, {"profile_weights": path})
    except SpeciationError as error:
        return error.report.select("table", F.col("line").isNotNull().alias("has_line"), "problem", "text")
    raise AssertionError("faulty lines were loaded")


def metadata_sources(spark, sf_dir):
    """The name a header would record for each page, its address taken for a path."""
    pages = bridge.read(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("keyword"), F.col("url").alias("path"))
    return files.recorded_sources(pages)


def _run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control.scenario_table(control.parse_control(bridge.control_lines(spark, sf_dir)))


def header_rows(spark, sf_dir):
    """Headers of one run per customer: gas, particulate and static output, all run types and both models."""
    runs = _run_table(tune(spark), sf_dir)
    recorded = [("GAS_PROFILES", "gas.csv"), ("PM_PROFILES", "pm.csv"), ("CAMX_FCRS", "fcrs.lst")]
    recorded += [("VBS_IVOC_FACTORS", "ivoc.csv"), ("VBS_SVOC_FACTORS", "svoc.csv")]
    more = inline_table(spark, recorded, "keyword string, dataval string").withColumn("version", F.lit(None).cast("string"))
    flags = mechanism.scenario_flags(runs.select("scenario_id", "mechanism"), bridge.mechanism_description(spark))
    rows = metadata_rows(bridge.metadata(spark).unionByName(more), runs, flags)
    return rows.select("scenario_id", "keyword", "dataval")


def gspro_files(spark, sf_dir):
    """Lines of split factors as they stand in the files of a run, read back in order."""
    folder = f"{new_folder(spark, 'out')}/gspro"
    write_lines(gspro_lines(_integrate_results(spark, sf_dir)), folder)
    return spark.read.text(folder).select("scenario_id", F.col("value").alias("line"))


# ---------------------------------------------------------------- checks


def required_settings(spark, sf_dir):
    return quality.missing_settings(_run_table(tune(spark), sf_dir))


def pm_run_types(spark, sf_dir):
    return quality.unsupported_pm_runs(_run_table(tune(spark), sf_dir))


def quality_pm_mechanism(spark, sf_dir):
    """Brands whose particulate mechanism has not exactly one computed pollutant."""
    mechanisms = bridge.brand_mechanisms(tune(spark), sf_dir)
    runs = mechanisms.select(F.col("mechanism").alias("scenario_id"), "mechanism").distinct()
    return quality.computed_species_count(mechanisms, runs).where("computed <> 1")


def empty_outputs(spark, sf_dir):
    """Nations, as runs, that the accounts in debt of suppliers give no row."""
    runs = bridge.read(tune(spark), sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("scenario_id"))
    rows = bridge.read(spark, sf_dir, "supplier").where("s_acctbal < 0")
    return quality.empty_outputs(runs, rows.select(F.col("s_nationkey").cast("string").alias("scenario_id")))


def quality_tolerance(spark, sf_dir):
    plan = _crit(spark, sf_dir)
    sums = gas.judged_sums(plan.judged())
    rows = quality.out_of_tolerance(sums, gas.gas_profiles(plan.batch.tables.profiles), 5.0)
    return _doubles(rows, "sum_pct")


def quality_missing_mw(spark, sf_dir):
    plan = _crit(spark, sf_dir)
    rows = plan.judged().where(F.col("fate") == gas.NO_MASS)
    return _doubles(rows.select("profile_id", "specie_id", "percent"), "percent")


def quality_unmapped_in_profiles(spark, sf_dir):
    plan = _crit(spark, sf_dir)
    unmapped = mechanism.unmapped_species(plan.species_runs())
    return quality.unmapped_in_profiles(plan.normalised_weights(), unmapped, plan.batch.tables.species)


def quality_over_100(spark, sf_dir):
    plan = _pm_plan(spark, sf_dir, _pm_scenario("ae8", "AE8"))
    return _doubles(quality.over_100(plan.mechanism_weights()), "sum_pct")


def quality_negative(spark, sf_dir):
    plan = _pm_plan(spark, sf_dir, _pm_scenario("ae8", "AE8"))
    return _doubles(quality.negative_components(plan.mechanism_weights(), plan.gap_filled_weights()), "percent")


def _supplied_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model species that carry the number of a supplier's nation."""
    return bridge.read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("B"), F.col("s_nationkey").cast("string")).alias("aqm_poll")
    )


def quality_missing_carbons(spark, sf_dir):
    """Carbon numbers known for the model species that carry the number of a supplier's nation."""
    plan = _crit(spark, sf_dir)
    known = _supplied_species(spark, sf_dir).withColumn("scenario_id", F.lit("crit"))
    return quality.missing_carbons(plan.mechanism_rows(), known)


def _named_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.read(spark, sf_dir, "part").select(
        F.col("p_name").alias("eminv_poll"),
        F.lit("EXH").alias("mode"),
        F.lit("Y").alias("model"),
        F.when(F.col("p_size") > 25, "V").otherwise("N").alias("voc"),
    )


def run_report(spark, sf_dir):
    """Every finding of a run whose inventory names are too long and whose carbon numbers have gaps."""
    tables = bridge.gas_tables(spark, sf_dir)
    known = tables.carbons.join(_supplied_species(spark, sf_dir), "aqm_poll", "left_semi")
    tables = tables.with_(invtable=_named_inventory(spark, sf_dir), carbons=known)
    return run_scenarios(tune(spark), [(_scenario("crit"), tables)]).report


def quality_name_width(spark, sf_dir):
    return quality.long_names(_named_inventory(spark, sf_dir))


def quality_name_width_pm(spark, sf_dir):
    return quality.long_names(_named_inventory(spark, sf_dir), pm=True)


def quality_toxics_cover(spark, sf_dir):
    listed = bridge.read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("specie_id"))
    return quality.uncovered_toxics(toxics.inventory_toxics(bridge.invtable(spark, sf_dir)), listed)


def quality_unclassified_toxics(spark, sf_dir):
    every_part = bridge.read(spark, sf_dir, "part").select(
        F.lit("CMAQ").alias("aqm_model"),
        F.col("p_partkey").cast("string").alias("specie_id"),
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("aqm_poll"),
    )
    classified = toxics.classify_toxics(every_part, bridge.invtable(spark, sf_dir), "CMAQ")
    return classified.where("active is null").select("specie_id", "aqm_poll")


def quality_hap_mw(spark, sf_dir):
    used = bridge.read(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("specie_id"))
    species = bridge.species(spark, sf_dir)
    rows = quality.invalid_hap_mw(used, toxics.no_toxics(species), species)
    return _doubles(rows, "volatile_mw")


def quality_pm_species(spark, sf_dir):
    plan = _pm_plan(spark, sf_dir, _pm_scenario("ae8", "AE8"))
    rows = quality.unknown_pm_species(plan.mechanism_rows(), plan.batch.tables.species)
    return rows.select("scenario_id", "specie_id", "aqm_poll")


def quality_svoc_cover(spark, sf_dir):
    filled = bridge.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("profile_id"))
    return quality.uncovered_svoc(pm.select_pm(bridge.profiles(spark, sf_dir)), filled)


def quality_svoc_sum(spark, sf_dir):
    first, second = F.lit(0.5), F.when(F.col("o_orderstatus") == "F", 0.5).otherwise(0.4)
    bins = [first, second, F.lit(0), F.lit(0), F.lit(0)]
    factors = bridge.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("profile_id"),
        *[b.cast("decimal(10,6)").alias(f"bin{i}") for i, b in enumerate(bins)],
    )
    return _doubles(quality.bad_svoc_sums(factors), "bin_sum")


# ---------------------------------------------------------------- corpus operators


def _corpus_module(name: str) -> ModuleType | None:
    """A module of the corpus operators, or None where they are not installed."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name not in (name, "emisplit.llm"):
            raise
        return None


def _corpus_entries(entry: str) -> dict:
    """What the corpus modules that are there list under ``entry``."""
    modules = (_corpus_module("emisplit.llm.queries"), _corpus_module("corpus_pipeline"))
    return {k: v for module in modules if module for k, v in getattr(module, entry)().items()}


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """Gas split factors of a plain run on the smallest tables."""
    return gas_split_factors(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        "gas_renormalised_weights": gas_renormalised_weights,
        "gas_unmapped_species": gas_unmapped_species,
        "gas_species_carbons": gas_species_carbons,
        "gas_moles_per_gram": gas_moles_per_gram,
        "gas_model_species": gas_model_species,
        "gas_split_factors": gas_split_factors,
        "gas_user_weights_splits": gas_user_weights_splits,
        "gas_voc_to_tog": gas_voc_to_tog,
        "gas_voc_to_tog_modes": gas_voc_to_tog_modes,
        "gas_integrate_splits": gas_integrate_splits,
        "gas_integrate_cnv": gas_integrate_cnv,
        "gas_integrate_header": gas_integrate_header,
        "gas_actox_profiles": gas_actox_profiles,
        "gas_nointegrate_splits": gas_nointegrate_splits,
        "haplist_splits": haplist_splits,
        "gas_vbs_splits": gas_vbs_splits,
        "gas_vbs_voc_to_tog": gas_vbs_voc_to_tog,
        "volatility_class": volatility,
        "pm_gap_filled_weights": pm_gap_filled_weights,
        "pm_fractions": _pm_query(_pm_scenario("ae6")),
        "pm_ae8_fractions": _pm_query(_pm_scenario("ae8", "AE8")),
        "pm_camx_fractions": _pm_query(_pm_scenario("camx", aqm="CAMX")),
        "pm_vbs_fractions": _pm_query(_pm_scenario("pmvbs", kind="VBS")),
        "pm_camx_vbs_fractions": _pm_query(_pm_scenario("pmvbscamx", aqm="CAMX", kind="VBS")),
        "pm_svoc_bins": pm_svoc_bins,
        "static_renamed_splits": static_renamed_splits,
        "profile_summary": profile_summary,
        "multi_scenario_splits": multi_scenario_splits,
        "gspro_lines": gspro_text,
        "gscnv_lines": gscnv_text,
        "volatility_lines": volatility_text,
        "clean_text": clean_text,
        "process_modes": process_modes,
        "invtable_lines": invtable_lines,
        "csv_weights": csv_weights,
        "plain_process": plain_process,
        "duplicate_weights": duplicate_weights,
        "control_runs": control_runs,
        "loaded_weights": loaded_weights,
        "load_report": load_report,
        "metadata_sources": metadata_sources,
        "header_rows": header_rows,
        "gspro_files": gspro_files,
        "required_settings": required_settings,
        "pm_run_types": pm_run_types,
        "quality_pm_mechanism": quality_pm_mechanism,
        "empty_outputs": empty_outputs,
        "quality_tolerance": quality_tolerance,
        "quality_missing_mw": quality_missing_mw,
        "quality_unmapped_in_profiles": quality_unmapped_in_profiles,
        "quality_over_100": quality_over_100,
        "quality_negative": quality_negative,
        "quality_missing_carbons": quality_missing_carbons,
        "quality_name_width": quality_name_width,
        "quality_name_width_pm": quality_name_width_pm,
        "quality_toxics_cover": quality_toxics_cover,
        "quality_unclassified_toxics": quality_unclassified_toxics,
        "quality_hap_mw": quality_hap_mw,
        "quality_pm_species": quality_pm_species,
        "quality_svoc_cover": quality_svoc_cover,
        "quality_svoc_sum": quality_svoc_sum,
        "run_report": run_report,
        **_corpus_entries("queries"),
    }


def oracle_sql() -> dict[str, str]:
    return {**oracles.statements(), **_corpus_entries("oracle_sql")}

"""Plans of whole runs: scenarios in, output tables out.

Scenarios that share run type, model, tolerance and input tables form a batch.
A batch is one plan keyed by ``scenario_id``: weights are selected, summed and
scaled once, and only the mechanism join multiplies the rows by scenario.

The scaled weights are written before anything else is planned (``emisplit.staging``), once for each
selection and tolerance, whatever run types, models and mechanisms use them. All outputs and reports start from
there; they are planned only, and work begins when one is read or ``Results.gate`` is called.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from emisplit.errors import SpeciationError
from emisplit.functions import inline_table
from emisplit.operators import gas, mechanism, outputs, pm, quality, toxics, vbs
from emisplit.operators.volatility import volatility_class
from emisplit.plans.metadata import metadata_rows
from emisplit.plans.scenario import CRITERIA, HAP_RUNS, HAPLIST, INTEGRATE, NOINTEGRATE, RUN_COLUMNS, VBS, Scenario
from emisplit.plans.tables import Tables
from emisplit.schemas import KEYS
from emisplit.staging import Staged, Stages, staged, written


@dataclass(frozen=True)
class Batch:
    """Scenarios that one plan computes together."""

    spark: SparkSession
    scenarios: tuple[Scenario, ...]
    tables: Tables
    case_insensitive: bool = False
    profiles_source: bool = False
    stages: Stages = field(default_factory=Stages)

    @property
    def first(self) -> Scenario:
        return self.scenarios[0]

    @property
    def ids(self) -> list[str]:
        return [s.run_name for s in self.scenarios]

    @property
    def runs(self) -> DataFrame:
        """The scenario table: a row of effective settings per scenario."""
        rows = [
            (s.run_name, s.mechanism, s.model, s.kind, s.outputs, s.output, s.pro_file, s.proc_file, s.mechanism == pm.VBS_MECHANISM)
            for s in self.scenarios
        ]
        return inline_table(self.spark, rows, f"{RUN_COLUMNS}, takes_vbs boolean")

    @property
    def flags(self) -> DataFrame:
        return mechanism.scenario_flags(
            self.runs, self.tables.mechanism_description, case_insensitive=self.case_insensitive
        )

    @property
    def flagged(self) -> DataFrame:
        return self.flags.where("nonsoaflag = 'Y'").select("scenario_id")


# ---------------------------------------------------------------- gas


@dataclass(frozen=True)
class GasPlan:
    """The gas side of a batch; every method returns a lazy DataFrame."""

    batch: Batch

    @property
    def kind(self) -> str:
        return self.batch.first.kind

    @property
    def aqm(self) -> str:
        return self.batch.first.model

    # toxics and inventory

    @property
    def uses_toxics(self) -> bool:
        return self.kind in HAP_RUNS and self.batch.tables.toxics is not None

    def classified(self) -> DataFrame:
        return toxics.classify_toxics(self.batch.tables.toxics, self.batch.tables.invtable, self.aqm)

    def toxics(self) -> DataFrame:
        if not self.uses_toxics:
            return toxics.no_toxics(self.batch.tables.species)
        return toxics.drop_unclassified(self.classified())

    def haps(self) -> DataFrame:
        return toxics.haps(self.batch.tables.invtable)

    # mechanism

    def mechanism_rows(self) -> DataFrame:
        return mechanism.mechanism_rows(self.batch.tables.mechanism, self.batch.runs)

    def carbon_rows(self) -> DataFrame:
        return mechanism.carbon_rows(self.batch.tables.carbons, self.batch.runs)

    def species_runs(self) -> DataFrame:
        return mechanism.species_carbons(
            self.batch.tables.species, self.mechanism_rows(), self.carbon_rows(), self.batch.ids
        )

    def model_carbons(self) -> DataFrame:
        extra, ivoc = None, None
        if self.uses_toxics:
            extra = mechanism.toxics_carbons(self.toxics(), self.species_runs(), self.batch.ids)
        if self.kind == VBS:
            ivoc = vbs.ivoc_names(self.batch.tables.ivoc_species, self.aqm)
        return mechanism.aqm_carbons(self.carbon_rows(), self.batch.ids, extra, ivoc)

    def mapping(self) -> DataFrame:
        """What each species gives each model species, per scenario."""
        t, ids = self.batch.tables, self.batch.ids
        mapped = mechanism.base_map(t.species, self.mechanism_rows(), self.carbon_rows(), ids)
        if self.uses_toxics:
            listed = self.toxics()
            mapped = mechanism.drop_active(mapped, listed)
            if self.kind != NOINTEGRATE:
                named = mechanism.toxics_map(listed, self.species_runs(), self.model_carbons(), ids)
                mapped = mapped.unionByName(named)
        if self.kind == VBS:
            names = vbs.ivoc_names(t.ivoc_species, self.aqm)
            mapped = mapped.unionByName(mechanism.ivoc_map(names, ids))
        return mapped

    # weights

    def selected(self, given: DataFrame) -> DataFrame:
        """Weights of the run among those ``given``, before any species is looked at."""
        t = self.batch.tables
        select = gas.select_gas if t.user_profile_wts is None else gas.select_user_weights
        return select(t.profiles, given)

    def staged(self) -> Staged:
        """Judged weights of the run's selection and tolerance, written by the first run that needs them."""
        t, tolerance = self.batch.tables, self.batch.first.tolerance_pct

        def write() -> Staged:
            def rows(given: DataFrame) -> DataFrame:
                return gas.raw_weights(self.selected(given), t.species)

            given = t.profile_weights if t.user_profile_wts is None else t.user_profile_wts
            counts = {name: F.count_if(F.col("fate") == name) for name in (gas.NO_MASS, gas.OUTSIDE)}
            return staged(given, rows, lambda part: gas.judged(part, tolerance), "gas_weights", counts)

        given = [t.profiles, t.species, t.user_profile_wts, None if t.user_profile_wts is not None else t.profile_weights]
        return self.batch.stages.get(("gas", tolerance), given, write)

    def judged(self) -> DataFrame:
        return self.staged().rows()

    def normalised_weights(self) -> DataFrame:
        return self.staged().each(self._normalised)

    def working_weights(self) -> DataFrame:
        return self.staged().each(self._working)

    def _normalised(self, part: DataFrame) -> DataFrame:
        scaled = gas.kept(part)
        if self.kind != VBS:
            return scaled
        t = self.batch.tables
        factors = vbs.ivoc_factors(
            t.vbs_ivoc_factors, t.ivoc_species, self.aqm, t.species.schema["volatile_mw"].dataType
        )
        return vbs.insert_ivoc(scaled, factors)

    def _working(self, part: DataFrame) -> DataFrame:
        scaled = self._normalised(part)
        hap_species = self.haps().select("specie_id").distinct() if self.kind in HAP_RUNS else None
        if self.kind == INTEGRATE:
            return toxics.integrate_weights(scaled, hap_species)
        if self.kind == NOINTEGRATE:
            return toxics.nointegrate_weights(scaled, hap_species, self.toxics())
        return scaled

    def _moles(self, part: DataFrame) -> DataFrame:
        weights = self._working(part).where("percent is not null")
        return gas.moles_by_species(gas.weight_moles(weights), self.mapping())

    def moles_by_species(self) -> DataFrame:
        return self.staged().each(self._moles)

    def model_species(self) -> DataFrame:
        return self.staged().each(lambda part: gas.model_species(self._moles(part)))

    # outputs

    @property
    def total_name(self) -> str:
        return "NONHAPTOG" if self.kind == INTEGRATE else "TOG"

    def actox_profiles(self) -> DataFrame:
        return toxics.actox_profiles(self.normalised_weights(), self.toxics())

    def haplist_masses(self) -> DataFrame:
        t, hap_names, listed = self.batch.tables, self.haps(), self.toxics()
        flagged = self.batch.flagged
        base = toxics.haplist_base(hap_names, mechanism.run_mechanism(self.mechanism_rows()))
        extra = toxics.haplist_toxics(hap_names, listed, t.primary)
        if t.primary is not None:
            extra = extra.unionByName(toxics.haplist_primary(hap_names, listed, t.primary))
        extra = mechanism.per_scenario(extra, self.batch.ids).join(F.broadcast(flagged), "scenario_id", "left_semi")
        rows = toxics.haplist_drop_active(base, listed, flagged).unionByName(extra)
        return toxics.haplist_masses(
            rows, self.species_runs(), self.model_carbons(), toxics.own_mass_names(listed, t.primary)
        )

    def splits(self) -> DataFrame:
        if self.kind == HAPLIST:
            return toxics.haplist_splits(self.haplist_masses())
        rows = gas.gas_splits(self.model_species(), self.total_name)
        flagged = self.batch.flagged
        if self.uses_toxics:
            actox = mechanism.per_scenario(self.actox_profiles(), self.batch.ids)
            actox = actox.join(F.broadcast(flagged), "scenario_id", "left_semi")
            rows = rows.unionByName(outputs.actox_rows(actox, self.total_name))
        if self.kind in (CRITERIA, VBS):
            rows = outputs.with_voc_rows(rows, flagged)
        return rows

    def conversions(self) -> DataFrame | None:
        if self.kind == HAPLIST:
            return None
        if self.kind == INTEGRATE:
            factors = gas.conversion_factors(
                self.working_weights(), "NONHAPVOC", "NONHAPTOG", zero_guard=False
            )
        else:
            factors = gas.conversion_factors(self.normalised_weights(), "VOC", "TOG")
        rows = mechanism.per_scenario(factors, self.batch.ids).select(outputs.CONVERSION_COLUMNS)
        t = self.batch.tables
        if t.gas_process is not None:
            rows = outputs.gscnv_modes(rows, t.gas_process, t.invtable)
        return rows

    def header(self) -> DataFrame | None:
        if self.kind != INTEGRATE:
            return None
        names = toxics.nhap_header(self.batch.tables.invtable).select("aqminv_poll")
        return mechanism.per_scenario(names, self.batch.ids)

    def findings(self) -> list[DataFrame]:
        t, ids = self.batch.tables, self.batch.ids
        found = []
        if t.invtable is not None:
            found.append(quality.check_name_width(t.invtable, ids))
        mech = self.mechanism_rows()
        unmapped = mechanism.unmapped_species(self.species_runs())
        if self.kind in HAP_RUNS:
            found.append(
                quality.check_toxics_cover(toxics.inventory_toxics(t.invtable), self.listed_toxics(), ids)
            )
            found.append(quality.check_hap_mw(self.haps(), self.toxics(), t.species, ids))
            if self.uses_toxics:
                found.append(quality.report_unclassified_toxics(self.classified(), ids))
        elif t.toxics is not None:
            found.append(quality.report_ignored_toxics(toxics.toxics_of_model(t.toxics, self.aqm), ids))
        found.append(quality.check_carbons(mech, self.carbon_rows()))
        found.append(quality.report_unmapped(unmapped))
        if self.kind != HAPLIST:
            rows, counts = self.judged(), self.staged().counts
            # What the staging counted as none needs no plan.
            if counts[gas.NO_MASS]:
                found.append(quality.report_missing_mw(rows.where(F.col("fate") == gas.NO_MASS), ids))
            if counts[gas.OUTSIDE]:
                profiles, tolerance = gas.gas_profiles(t.profiles), self.batch.first.tolerance_pct
                found.append(quality.report_tolerance(gas.judged_sums(rows), profiles, tolerance, ids))
            found.append(quality.report_unmapped_in_profiles(self.normalised_weights(), unmapped, t.species))
            if self.kind == VBS:
                weighed = rows.where(F.col("fate") != gas.NO_MASS)
                found.append(quality.report_ivoc_without_weights(t.vbs_ivoc_factors, weighed, ids))
        return found

    def listed_toxics(self) -> DataFrame:
        """Toxics of the model as given, classified or not."""
        if not self.uses_toxics:
            return self.toxics()
        return toxics.toxics_of_model(self.batch.tables.toxics, self.aqm)


# ---------------------------------------------------------------- particulates


@dataclass(frozen=True)
class PmPlan:
    """The particulate side of a batch."""

    batch: Batch

    @property
    def is_camx_ae6(self) -> bool:
        return self.batch.first.model == "CAMX" and self.batch.first.mechanism == "AE6"

    def profiles(self) -> DataFrame:
        return pm.select_pm(self.batch.tables.profiles)

    def mechanism_rows(self) -> DataFrame:
        return pm.pm_mechanism_rows(self.batch.tables.pm_mechanism, self.batch.runs)

    def selected(self, given: DataFrame) -> DataFrame:
        """Weights of the run among those ``given``."""
        t = self.batch.tables
        select = pm.pm_raw_weights if t.user_profile_wts is None else pm.pm_user_weights
        return select(t.profiles, given)

    def staged(self) -> Staged:
        """Gap-filled weights of the run's selection, written by the first run that needs them."""
        t = self.batch.tables

        def write() -> Staged:
            given = t.profile_weights if t.user_profile_wts is None else t.user_profile_wts
            counts = {"negative": F.count_if(F.col("percent") < 0)}
            return staged(given, self.selected, lambda part: pm.fill_gaps(part, t.o2m_ratios), "pm_weights", counts)

        given = [t.profiles, t.o2m_ratios, t.user_profile_wts, None if t.user_profile_wts is not None else t.profile_weights]
        return self.batch.stages.get(("pm",), given, write)

    def gap_filled_weights(self) -> DataFrame:
        return self.staged().rows().drop("lowest")

    def _in_mechanism(self, part: DataFrame) -> DataFrame:
        return pm.mechanism_weights(part, self.mechanism_rows())

    def mechanism_weights(self) -> DataFrame:
        return self.staged().each(self._in_mechanism)

    def base_fractions(self) -> DataFrame:
        return self.staged().each(lambda part: pm.pm_fractions(self._in_mechanism(part)))

    def fractions(self) -> DataFrame:
        rows, t, run = self.base_fractions(), self.batch.tables, self.batch.first
        if self.is_camx_ae6:
            rows = pm.camx_fractions(rows, t.camx_fcrs)
        if run.kind == VBS:
            rows = vbs.svoc_splits(rows, vbs.svoc_bins(t.vbs_svoc_factors, run.model), run.model)
        return rows

    def splits(self) -> DataFrame:
        return pm.pm_splits(self.fractions())

    def findings(self) -> list[DataFrame]:
        t, ids, runs = self.batch.tables, self.batch.ids, self.batch.runs
        found = []
        if t.invtable is not None:
            found.append(quality.check_name_width(t.invtable, ids, pm=True))
        weights, filled = self.mechanism_weights(), self.gap_filled_weights()
        found += [
            quality.check_pm_mechanism(t.pm_mechanism, runs),
            quality.check_pm_species(self.mechanism_rows(), t.species),
            quality.duplicate_keys(filled, ["profile_id", "specie_id"], "pm_duplicate_species"),
            quality.report_over_100(weights, self.profiles()),
        ]
        if self.staged().counts["negative"]:
            found.append(quality.report_negative(weights, filled, self.profiles()))
        if self.batch.first.kind == VBS:
            found.append(quality.check_svoc_cover(self.profiles(), t.vbs_svoc_factors, runs))
            found.append(quality.check_svoc_sums(t.vbs_svoc_factors, ids))
        return found


# ---------------------------------------------------------------- runs


@dataclass(frozen=True)
class Results:
    """Output tables of a set of scenarios, all keyed by ``scenario_id``."""

    scenarios: tuple[Scenario, ...]
    splits: DataFrame
    conversions: DataFrame | None
    header: DataFrame | None
    volatility: DataFrame | None
    metadata: DataFrame | None
    checks: DataFrame | None

    @property
    def report(self) -> DataFrame | None:
        """Every finding of the input checks and of the check of the splits' key."""
        if self.checks is None:
            return None
        return self.checks.unionByName(quality.duplicate_keys(self.splits, KEYS["gspro"], "duplicate_split"))

    def written(self) -> "Results":
        """The same results with splits and conversions written once, so that checks and sinks read what is there."""
        parts = {name: getattr(self, name) for name in ("splits", "conversions")}
        return replace(self, **{name: written(rows, name)[0] for name, rows in parts.items() if rows is not None})

    def gate(self) -> "Results":
        """Raise when input checks or the key of the splits are violated.

        One job looks at all checks. The error names every violated check with
        its number of findings and the smallest of them; ``report`` has all.
        """
        if self.checks is None:
            return self
        first = F.min(F.struct(*[c for c in quality.REPORT_COLUMNS if c != "check"])).alias("first")
        errors = self.report.where(F.col("severity") == quality.ERROR).groupBy("check")
        failed = errors.agg(F.count("*").alias("findings"), first).orderBy("check").collect()
        if failed:
            kinds = ", ".join(f"{r['check']} ({r['findings']})" for r in failed)
            rows = [Row(check=r["check"], findings=r["findings"], **r["first"].asDict()) for r in failed]
            raise SpeciationError(f"speciation stopped: {kinds}; the first of each", rows)
        return self

    def summary(self) -> DataFrame:
        return outputs.profile_count(self.splits)


def _union(parts: Iterable[DataFrame | None]) -> DataFrame | None:
    present = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, present) if present else None


def _batches(
    spark: SparkSession,
    runs: list[tuple[Scenario, Tables]],
    case_insensitive: bool,
    profiles_source: bool,
) -> list[Batch]:
    groups: dict[tuple, list[Scenario]] = {}
    tables: list[Tables] = []
    for scenario, inputs in runs:
        camx_ae6 = scenario.model == "CAMX" and scenario.mechanism == "AE6"
        place = next((i for i, known in enumerate(tables) if known.same(inputs)), len(tables))
        if place == len(tables):
            tables.append(inputs)
        key = (
            place, scenario.outputs, scenario.kind, scenario.model, scenario.tolerance_pct, camx_ae6,
        )
        groups.setdefault(key, []).append(scenario)
    stages = Stages()
    return [Batch(spark, tuple(g), tables[k[0]], case_insensitive, profiles_source, stages) for k, g in groups.items()]


def _batch_results(batch: Batch, with_report: bool) -> Results:
    run, t = batch.first, batch.tables
    parts, checks = [], []
    conversions = header = volatility = None
    if run.wants_gas:
        plan = GasPlan(batch)
        parts.append(plan.splits())
        conversions, header = plan.conversions(), plan.header()
        volatility = mechanism.per_scenario(volatility_class(t.species), batch.ids)
        if with_report:
            checks += plan.findings()
    if run.wants_pm:
        pm_plan = PmPlan(batch)
        parts.append(pm_plan.splits())
        if with_report:
            checks += pm_plan.findings()
    if run.wants_static:
        parts.append(outputs.static_rows(t.static, batch.runs, batch.ids))
    if not parts:
        raise SpeciationError(f"run {run.run_name}: output {run.output!r} selects nothing")
    splits = _union(parts)
    if t.rename_species is not None:
        splits = outputs.rename_model_species(splits, t.rename_species, batch.runs)
    splits = outputs.drop_unknown(splits, batch.flags)
    metadata = None
    if t.metadata is not None:
        metadata = metadata_rows(t.metadata, batch.runs, batch.flags, profiles_source=batch.profiles_source)
    checks = _union(checks) if checks or not with_report else _no_findings(splits)
    return Results(batch.scenarios, splits, conversions, header, volatility, metadata, checks)


def _no_findings(splits: DataFrame) -> DataFrame:
    return quality.finding(splits.where(F.lit(False)), quality.ERROR, "none", "")


def run_scenarios(
    spark: SparkSession,
    runs: Iterable[tuple[Scenario, Tables]],
    *,
    with_report: bool = True,
    case_insensitive_mechanism: bool = False,
    profiles_source: bool = False,
) -> Results:
    """Write the weights that the scenarios need, and plan the rest; any number of scenarios, names must differ.

    The two last options deviate on request: mechanism descriptions are found
    in any case, and the header names the source of the profile weights.
    """
    runs = list(runs)
    names = [s.run_name for s, _ in runs]
    if not runs or len(set(names)) != len(names):
        raise SpeciationError(f"scenario names must be given and differ: {names}")
    for scenario, _ in runs:
        scenario.check_required().check_pm_run_type()
    batches = _batches(spark, runs, case_insensitive_mechanism, profiles_source)
    done = [_batch_results(b, with_report) for b in batches]
    return Results(
        tuple(s for s, _ in runs),
        _union(r.splits for r in done),
        _union(r.conversions for r in done),
        _union(r.header for r in done),
        _union(r.volatility for r in done),
        _union(r.metadata for r in done),
        _union(r.checks for r in done),
    )


def speciate(spark: SparkSession, scenario: Scenario, tables: Tables, **options) -> Results:
    """Plan one scenario."""
    return run_scenarios(spark, [(scenario, tables)], **options)

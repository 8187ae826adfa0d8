import pytest
from pyspark.sql import functions as F

from conftest import values
from emisplit import Scenario, SpeciationError, Tables, bridge
from emisplit.functions import grouping
from emisplit.plans.speciation import Batch, PmPlan, speciate

PROFILES = (
    "profile_id string, profile_name string, profile_type string, lower_size decimal(10,4), upper_size decimal(10,4), "
    "gen_mechanism string, sec_equipment string"
)
WEIGHTS = "profile_id string, specie_id string, percent decimal(12,6)"


def _tables(spark, table, weights, kind="PM", mechanism=None, equipment=None, **more):
    ids = sorted({w[0] for w in weights})
    return Tables(
        species=table([(s,) for s, _ in bridge.AE6 + bridge.AE8], "specie_id string").distinct(),
        profiles=table([(i, "name " + i, kind, 0, 2.5, mechanism, equipment) for i in ids], PROFILES),
        profile_weights=table(weights, WEIGHTS),
        pm_mechanism=bridge.pm_mechanism(spark),
        o2m_ratios=bridge.o2m_ratios(spark),
        **more,
    )


def _plan(spark, tables, mech="AE6", aqm="CMAQ", kind="CRITERIA"):
    run = Scenario("run", mech_basis=mech, run_type=kind, aqm=aqm, output="PM")
    return PmPlan(Batch(spark, (run,), tables))


def _filled(spark, table, weights, **kwargs):
    rows = [("p", s, w) for s, w in weights.items()]
    plan = _plan(spark, _tables(spark, table, rows, **kwargs))
    return {s: round(p, 8) for s, p in values(plan.gap_filled_weights(), "specie_id", "percent")}


def test_sulfate_from_sulfur(spark, table):
    assert _filled(spark, table, {"700": 2}, kind="PM-AE6") == {"700": 2, "699": 6}
    assert _filled(spark, table, {"700": 2, "699": 1}, kind="PM-AE6") == {"700": 2, "699": 1}


def test_water(spark, table):
    assert _filled(spark, table, {"699": 10, "784": 5})["2668"] == 3.6
    assert "2668" not in _filled(spark, table, {"699": 10}, mechanism="Combustion")
    assert _filled(spark, table, {"699": 10, "2668": 1})["2668"] == 1
    assert "2668" not in _filled(spark, table, {"626": 10})
    assert _filled(spark, table, {"700": 1})["2668"] == 0.72  # from the derived sulfate


def test_metal_bound_oxygen(spark, table):
    assert _filled(spark, table, {"488": 10})["2670"] == 3.58
    # 12 of sulfate, 3 of ammonium take 8; a sixth of the rest is oxygen.
    assert _filled(spark, table, {"488": 10, "699": 12, "784": 3})["2670"] == round(3.58 - 4 / 6, 8)
    assert _filled(spark, table, {"488": 1, "699": 30})["2670"] == 0
    assert _filled(spark, table, {"488": 10, "699": 4, "784": 3})["2670"] == 3.58


@pytest.mark.parametrize(
    "mechanism, equipment, factor",
    [
        (None, None, 0.4),
        ("Combustion", None, 0.4),
        ("Combustion", "Mobile source", 0.25),
        ("Evaporation", "Mobile source", 0.4),
        ("Combustion", "Mobile biomass burning", 0.7),
        (None, "biomass burning boiler", 0.4),
    ],
)
def test_non_carbon_organics(spark, table, mechanism, equipment, factor):
    filled = _filled(spark, table, {"626": 10}, mechanism=mechanism, equipment=equipment)
    assert filled["2669"] == pytest.approx(10 * factor)


def test_double_counted_species_are_dropped(spark, table):
    assert _filled(spark, table, {"294": 1, "436": 1, "797": 5}, kind="PM-AE6") == {"797": 5}


def test_ions_replace_atoms_and_oxides(spark, table):
    ae6 = {"kind": "PM-AE6"}
    assert _filled(spark, table, {"669": 3}, **ae6) == {"2302": 3}
    assert _filled(spark, table, {"669": 3, "2302": 1}, **ae6) == {"2302": 1}
    assert _filled(spark, table, {"669": 3, "2302": 0}, **ae6) == {"2302": 3}
    assert _filled(spark, table, {"2847": 7}, **ae6) == {"2303": 5}
    assert _filled(spark, table, {"2847": 7, "329": 1}, **ae6) == {"2303": 1}
    assert _filled(spark, table, {"2852": 5, "2772": 2}, **ae6) == {"2772": 2}
    assert _filled(spark, table, {"785": 0, "797": 1}, **ae6) == {"797": 1}


def test_only_organics_absorb_a_small_excess(spark, table):
    filled = _filled(spark, table, {"626": 50, "797": 60, "700": 0})
    # Organics 50 and 20 have room for 40 of 70.
    assert filled["797"] == 60 and filled["626"] == round(50 * 40 / 70, 8) and filled["2669"] == round(20 * 40 / 70, 8)


def test_everything_absorbs_a_large_excess(spark, table):
    filled = _filled(spark, table, {"626": 10, "797": 120, "2668": 0})
    assert filled["797"] == round(120 / 134 * 100, 8)
    assert sum(filled.values()) == pytest.approx(100, abs=1e-6)


def test_fractions_and_remainder(spark, table):
    rows = [("a", "797", 60), ("a", "613", 10), ("b", "797", 100.5), ("c", "797", 101), ("d", "797", 50), ("d", "699", -1)]
    plan = _plan(spark, _tables(spark, table, rows, kind="PM-AE6"))
    # Up to 101 percent is kept without a remainder; negatives drop a profile.
    assert values(plan.fractions(), "profile_id", "aqm_poll", "fraction") == [
        ("a", "PEC", 0.6),
        ("a", "PMOTHR", 0.3),
        ("a", "PNO3", 0.1),
        ("b", "PEC", 1.005),
    ]
    report = speciate(spark, plan.batch.first, plan.batch.tables).gate().report
    assert values(report.where("severity = 'WARNING'"), "check", "profile_id") == [
        ("pm_negative", "d"),
        ("pm_over_100", "c"),
    ]


def test_size_and_type_selection(spark, table):
    tables = _tables(spark, table, [("a", "797", 60), ("b", "797", 60)], kind="PM-VBS")
    assert _plan(spark, tables).fractions().count() == 0
    assert _plan(spark, tables, "AE8").fractions().count() == 4
    coarse = tables.with_(profiles=tables.profiles.withColumn("upper_size", F.lit(10).cast("decimal(10,4)")))
    assert _plan(spark, coarse, "AE8").fractions().count() == 0


def test_camx_names(spark, table):
    rows = [("a", "626", 20), ("a", "2669", 8), ("a", "797", 10), ("a", "488", 5), ("a", "785", 2), ("b", "488", 5)]
    tables = _tables(spark, table, rows, kind="PM-AE6", camx_fcrs=table([("b",)], "profile_id string"))
    assert values(_plan(spark, tables, aqm="CAMX").fractions(), "profile_id", "aqm_poll", "fraction") == [
        ("a", "FPRM", 0.6),
        ("a", "NA", 0.02),
        ("a", "PEC", 0.1),
        ("a", "POA", 0.28),
        ("a", "POC", 0.2),
        ("b", "FCRS", 1.0),
    ]


@pytest.mark.parametrize("aqm, names", [("CMAQ", ("P_PVB0", "P_PVB2")), ("CAMX", ("PAP0", "PAP2"))])
def test_volatility_bins_conserve_mass(spark, table, aqm, names):
    factors = table(
        [("a", "P_PVB", "PAP", 0.25, 0, 0.75, 0, 0)],
        "profile_id string, cmaq_svocname string, camx_svocname string, bin0 decimal(10,6), bin1 decimal(10,6), "
        "bin2 decimal(10,6), bin3 decimal(10,6), bin4 decimal(10,6)",
    )
    rows = [("a", "626", 20), ("a", "2669", 8), ("a", "797", 10)]
    tables = _tables(spark, table, rows, kind="PM-AE6", vbs_svoc_factors=factors)
    got = dict(values(_plan(spark, tables, aqm=aqm, kind="VBS").fractions(), "aqm_poll", "fraction"))
    assert (got[names[0]], got[names[1]]) == (0.07, 0.21)
    assert not {"POA", "PNCOM"} & set(got)
    run = Scenario("run", mech_basis="AE6", run_type="VBS", aqm=aqm, output="PM")
    speciate(spark, run, tables).gate()
    with pytest.raises(SpeciationError, match="volatility factors"):
        speciate(spark, run, tables.with_(vbs_svoc_factors=factors.where("profile_id = 'x'"))).gate()
    uneven = factors.withColumn("bin0", F.lit(0.3).cast("decimal(10,6)"))
    with pytest.raises(SpeciationError, match="add up to one"):
        speciate(spark, run, tables.with_(vbs_svoc_factors=uneven)).gate()


def test_mechanism_checks(spark, table):
    tables = _tables(spark, table, [("a", "797", 60)])
    run = Scenario("run", mech_basis="AE6", run_type="CRITERIA", aqm="CMAQ", output="PM")
    with pytest.raises(SpeciationError, match="one computed"):
        speciate(spark, run, tables.with_(pm_mechanism=tables.pm_mechanism.where("not compute"))).gate()
    with pytest.raises(SpeciationError, match="species table"):
        speciate(spark, run, tables.with_(species=tables.species.where("specie_id <> '626'"))).gate()


def test_gate_names_every_failed_check(spark, table):
    tables = _tables(spark, table, [("a", "626", 20), ("a", "2669", 8)])
    tables = tables.with_(species=tables.species.where("specie_id not in ('626', '797')"))
    run = Scenario("run", mech_basis="AE6", run_type="CRITERIA", aqm="CMAQ", output="PM")
    with pytest.raises(SpeciationError) as raised:
        speciate(spark, run, tables).gate()
    found = {r["check"]: r["findings"] for r in raised.value.rows}
    assert found["pm_species"] == 2 and found["pm_duplicate_species"] == 1


def test_existing_derived_species_stop_the_run(spark, table):
    tables = _tables(spark, table, [("a", "626", 20), ("a", "2669", 8)])
    run = Scenario("run", mech_basis="AE6", run_type="CRITERIA", aqm="CMAQ", output="PM")
    with pytest.raises(SpeciationError, match="duplicate key"):
        speciate(spark, run, tables).gate()


@pytest.mark.parametrize("whole, salts", [(0, 1), (0, 2), (2, 2)])
def test_any_split_of_profiles_gives_the_same_result(spark, table, whole, salts, monkeypatch):
    rows = [("a", "626", 50), ("a", "797", 60), ("a", "700", 1), ("a", "669", 2), ("b", "797", 10), ("b", "2847", 7)]
    tables = _tables(spark, table, rows)
    columns = ("profile_id", "aqm_poll", "fraction")
    want = values(_plan(spark, tables).fractions(), *columns)
    monkeypatch.setattr(grouping, "SALTS", salts)
    monkeypatch.setattr(grouping, "WHOLE", whole)
    cut = _plan(spark, tables)
    assert cut.staged().shares.count() and bool(cut.staged().whole.count()) == bool(whole)
    assert want and values(cut.fractions(), *columns) == want

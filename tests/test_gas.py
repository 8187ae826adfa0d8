import pytest
from pyspark.sql import functions as F

from conftest import values
from emisplit import Scenario, SpeciationError, Tables
from emisplit.functions import grouping
from emisplit.plans.speciation import Batch, GasPlan, run_scenarios, speciate

SPECIES = "specie_id string, specie_name string, molecular_weight decimal(20,12), non_voctog boolean, volatile_mw decimal(20,12), vp_epi decimal(20,12)"


@pytest.fixture(scope="module")
def tables(table):
    return Tables(
        species=table(
            [
                ("1", "one", 30, False, 30, 1),
                ("2", "two", 60, False, 60, 1),
                ("3", "no mass", 50, False, -99, 0),
                ("4", "unmapped", 40, True, 40, -99),
                ("529", "methane", 16, True, 16, 1),
            ],
            SPECIES,
        ),
        profiles=table(
            [("G1", "gas", "GAS"), ("G2", "low", "GAS-VBS"), ("G3", "toxic", "GAS"), ("P", "pm", "PM")],
            "profile_id string, profile_name string, profile_type string",
        ),
        profile_weights=table(
            [("G1", "1", 50), ("G1", "2", 30), ("G1", "4", 20), ("G1", "3", 7), ("G2", "1", 80), ("G2", "9", 20)]
            + [("G3", "2", 99), ("P", "1", 100), ("G1", "529", 0)],
            "profile_id string, specie_id string, percent decimal(12,6)",
        ),
        mechanism=table(
            [("MM", "1", "PAR", 2), ("MM", "2", "PAR", 1), ("MM", "2", "OLE", 1), ("MM", "529", "CH4", 1), ("MM", "4", "PAR", 0)],
            "mechanism string, specie_id string, aqm_poll string, moles_per_mole decimal(20,12)",
        ),
        carbons=table(
            [("MM", "PAR", 1), ("MM", "OLE", 2), ("MM", "CH4", 1)],
            "mechanism string, aqm_poll string, num_carbons decimal(5,2)",
        ),
        mechanism_description=table(
            [("MM", "", "Y", "", "", ""), ("Mixed", "", "N", "", "", "hidden")],
            "mechanism string, description string, nonsoaflag string, origin string, reference string, comment string",
        ),
        invtable=table(
            [("TWO", "", "2", "Y", "V", "Y", "Y"), ("FOUR", "EXH", "4", "Y", "T", "Y", "N"), ("CO", "EXH", "0", "N", "N", "N", "N")],
            "eminv_poll string, mode string, specie_id string, keep string, voc string, model string, explicit string",
        ),
    )


@pytest.fixture(scope="module")
def toxics(table):
    return table(
        [("CMAQ", "2", "TWO_T"), ("CMAQ", "4", "FOUR_T"), ("CMAQ", "1", "ONE_T"), ("CAMX", "2", "X")],
        "aqm_model string, specie_id string, aqm_poll string",
    )


def scenario(kind="CRITERIA", name="run", **more):
    return Scenario(name, **({"mech_basis": "MM", "run_type": kind, "aqm": "CMAQ", "output": "VOC"} | more))


def plan(spark, tables, *args, **kwargs):
    return GasPlan(Batch(spark, (scenario(*args, **kwargs),), tables))


def test_renormalised_weights(spark, tables):
    rows = plan(spark, tables).normalised_weights()
    # G2 loses the unknown species and falls out of tolerance; G3 is scaled up.
    assert values(rows, "profile_id", "specie_id", "percent") == [
        ("G1", "1", 50.0),
        ("G1", "2", 30.0),
        ("G1", "4", 20.0),
        ("G3", "2", 100.0),
    ]


def test_unknown_user_profiles_skip_the_tolerance(spark, tables, table):
    user = table([("G1", "1", 50), ("NEW", "1", 50)], "profile_id string, specie_id string, percent decimal(10,6)")
    rows = plan(spark, tables.with_(user_profile_wts=user)).normalised_weights()
    assert values(rows, "profile_id", "percent") == [("NEW", 100.0)]


def test_species_carbons(spark, tables):
    rows = plan(spark, tables).species_runs()
    assert values(rows, "specie_id", "num_carbons", "unmapped") == [
        ("1", 2.0, False),
        ("2", 3.0, False),
        ("3", 1.0, True),
        ("4", 1.0, True),
        ("529", 1.0, False),
    ]


def test_mapping(spark, tables):
    rows = plan(spark, tables).mapping()
    assert values(rows, "specie_id", "aqm_poll", "moles_per_mole", "gram_per_mole") == [
        ("1", "PAR", 2.0, 15.0),
        ("2", "OLE", 1.0, 40.0),
        ("2", "PAR", 1.0, 20.0),
        ("3", "UNK", 1.0, -99.0),
        ("4", "UNK", 1.0, 40.0),
        ("529", "CH4", 1.0, 16.0),
    ]


def test_split_factors_by_hand(spark, tables):
    rows = plan(spark, tables).splits().where("profile_id = 'G1' and eminv_poll = 'TOG'")
    got = {r["aqm_poll"]: (float(r["mass_fraction"]), float(r["divisor"])) for r in rows.collect()}
    # Species 2 has one PAR (20 of 60 g) and one OLE carbon pair (40 of 60 g).
    assert got["PAR"][0] == pytest.approx(0.5 + 0.3 / 3, abs=2e-6)
    assert got["OLE"][0] == pytest.approx(0.3 * 2 / 3, abs=2e-6)
    assert got["UNK"][0] == pytest.approx(0.2, abs=2e-6)
    assert got["OLE"][1] == pytest.approx(40, abs=1e-5)
    par_moles = {"1": 0.5 / 30 * 2, "2": 0.3 / 60}
    average = (par_moles["1"] * 15 + par_moles["2"] * 20) / sum(par_moles.values())
    assert got["PAR"][1] == pytest.approx(average, abs=1e-5)


@pytest.mark.parametrize("kind", ["CRITERIA", "INTEGRATE", "NOINTEGRATE"])
def test_closed_form(spark, tables, toxics, kind):
    """Normalisation by moles cancels: mass follows percent and carbons."""
    p = plan(spark, tables.with_(toxics=toxics), kind)
    weights = p.working_weights().where("percent is not null")
    direct = (
        weights.join(p.mapping(), "specie_id")
        .groupBy("profile_id", "aqm_poll")
        .agg(F.sum(F.col("percent") / 100 * F.col("moles_per_mole") * F.col("gram_per_mole") / F.col("volatile_mw")).alias("want"))
    )
    rows = p.splits().where(F.col("eminv_poll") == p.total_name).where("divisor <> 1")
    pairs = rows.join(direct, ["profile_id", "aqm_poll"], "full").select("mass_fraction", "want").collect()
    assert pairs
    for got, want in pairs:
        assert float(got) == pytest.approx(float(want), abs=5e-6)


def test_identity_rows_need_the_flag(spark, tables):
    assert values(plan(spark, tables).splits().where("eminv_poll = 'VOC'"), "profile_id", "split_factor") == [
        ("G1", 1.0),
        ("G3", 1.0),
    ]
    # The name is looked up in upper case: a mixed case description has no flag.
    mixed = tables.with_(
        mechanism=tables.mechanism.withColumn("mechanism", F.lit("MIXED")),
        carbons=tables.carbons.withColumn("mechanism", F.lit("MIXED")),
    )
    kept = speciate(spark, scenario(mech_basis="Mixed"), mixed, with_report=False).splits
    assert kept.where("aqm_poll = 'UNK'").count() == 1 and kept.where("eminv_poll = 'VOC'").count() == 0
    hidden = speciate(
        spark, scenario(mech_basis="Mixed"), mixed, with_report=False, case_insensitive_mechanism=True
    ).splits
    assert hidden.where("aqm_poll = 'UNK'").count() == 0


def test_integrate(spark, tables, toxics):
    p = plan(spark, tables.with_(toxics=toxics), "INTEGRATE")
    kinds = {r["specie_id"]: r["active"] for r in p.classified().collect()}
    assert kinds == {"1": None, "2": "A", "4": "T"}
    rows = p.working_weights()
    assert values(rows.where("percent is not null"), "profile_id", "specie_id", "percent") == [("G1", "1", 100.0)]
    assert values(p.actox_profiles(), "profile_id") == [("G3",)]
    splits = p.splits()
    assert values(splits.where("profile_id = 'G3'"), "eminv_poll", "aqm_poll", "split_factor", "divisor") == [
        ("NONHAPTOG", "VOC", 0.0, 1.0)
    ]
    # A profile of HAPs only has no denominator.
    assert values(p.conversions(), "profile_id", "from_specie", "to_specie", "cnv_factor") == [
        ("G1", "NONHAPVOC", "NONHAPTOG", 1.0),
        ("G3", "NONHAPVOC", "NONHAPTOG", 0.0),
    ]
    assert values(p.header(), "aqminv_poll") == [("EXH__FOUR",), ("TWO",)]


def test_nointegrate_keeps_the_loss(spark, tables, toxics):
    p = plan(spark, tables.with_(toxics=toxics), "NOINTEGRATE")
    assert values(p.working_weights(), "profile_id", "specie_id", "percent") == [("G1", "1", 50.0), ("G1", "4", 20.0)]
    total = p.splits().where("profile_id = 'G1'").agg(F.sum("mass_fraction")).first()[0]
    assert float(total) == pytest.approx(0.7, abs=5e-6)
    assert p.mapping().where("aqm_poll like '%_T'").count() == 0


def test_haplist(spark, tables, toxics, table):
    primary = table(
        [("FOUR", "FOUR_P", 0.25, "N"), ("OTHER", "X", 1, "Y")],
        "aqminv_poll string, aqm_add string, split_factor decimal(12,8), writeflag string",
    )
    p = plan(spark, tables.with_(toxics=toxics, primary=primary), "HAPLIST")
    # TWO is active: only its toxic name. FOUR is a tracer: toxic and primary
    # names, each also as not integrated; the mechanism does not map it.
    assert values(p.splits(), "profile_id", "eminv_poll", "aqm_poll", "split_factor", "divisor") == [
        ("0000", "FOUR", "FOUR_P", 0.25, 40.0),
        ("0000", "FOUR", "FOUR_T", 1.0, 40.0),
        ("0000", "FOUR_NOI", "FOUR_P", 0.25, 40.0),
        ("0000", "FOUR_NOI", "FOUR_T", 1.0, 40.0),
        ("0000", "TWO", "TWO_T", 1.0000002, 60.0),
    ]
    overwritten = primary.withColumn("writeflag", F.lit("Y"))
    p = plan(spark, tables.with_(toxics=toxics, primary=overwritten), "HAPLIST")
    assert p.splits().where("aqm_poll = 'FOUR_T'").count() == 0
    assert p.conversions() is None


def test_vbs(spark, tables, table):
    vbs = tables.with_(
        vbs_ivoc_factors=table(
            [("G1", "IVOC_X", "IVOX", 0.2), ("NONE", "IVOC_X", "IVOX", 0.2)],
            "profile_id string, cmaq_ivocname string, camx_ivocname string, nmogfraction decimal(10,6)",
        ),
        ivoc_species=table([("CMAQ", "IVOC_X", 200), ("CAMX", "IVOX", 100)], "aqm string, specie_id string, molwt decimal(10,6)"),
        profile_weights=table(
            [("G1", "1", 50), ("G1", "529", 50)], "profile_id string, specie_id string, percent decimal(12,6)"
        ),
    )
    p = plan(spark, vbs, "VBS")
    assert values(p.normalised_weights(), "specie_id", "percent") == [("1", 40.0), ("529", 50.0), ("IVOC_X", 10.0)]
    rows = p.splits().where("eminv_poll = 'TOG'")
    got = {r["aqm_poll"]: (float(r["mass_fraction"]), float(r["divisor"])) for r in rows.collect()}
    assert got["IVOC_X"] == (pytest.approx(0.1, abs=1e-6), pytest.approx(200))
    assert got["CH4"][0] == pytest.approx(0.5, abs=1e-6)
    assert values(p.conversions(), "cnv_factor") == [(2.0,)]


def test_conversion_factors_and_modes(spark, tables, table):
    process = table([("G1", "EXH"), ("G1", "EVP"), ("G3", "")], "profile_id string, process string")
    rows = plan(spark, tables.with_(gas_process=process)).conversions()
    assert values(rows, "from_specie", "to_specie", "profile_id", "cnv_factor") == [
        ("EXH__VOC", "EXH__TOG", "G1", 1.25),
        ("VOC", "TOG", "G1", 1.25),
        ("VOC", "TOG", "G3", 1.0),
        ("__VOC", "__TOG", "G3", 1.0),
    ]


@pytest.mark.parametrize("kind", ["CRITERIA", "INTEGRATE", "VBS"])
@pytest.mark.parametrize("whole, salts", [(0, 1), (0, 2), (2, 2)])
def test_any_split_of_profiles_gives_the_same_result(spark, tables, toxics, table, kind, whole, salts, monkeypatch):
    """All profiles in shares, or only those of more than two rows."""
    extra = tables.with_(
        toxics=toxics,
        vbs_ivoc_factors=table(
            [("G1", "IVOC_X", "IVOX", 0.2)],
            "profile_id string, cmaq_ivocname string, camx_ivocname string, nmogfraction decimal(10,6)",
        ),
        ivoc_species=table([("CMAQ", "IVOC_X", 200)], "aqm string, specie_id string, molwt decimal(10,6)"),
    )
    columns = ("profile_id", "eminv_poll", "aqm_poll", "split_factor", "divisor")
    want = values(plan(spark, extra, kind).splits(), *columns)
    monkeypatch.setattr(grouping, "SALTS", salts)
    monkeypatch.setattr(grouping, "WHOLE", whole)
    cut = plan(spark, extra, kind)
    assert cut.staged().shares.count() and bool(cut.staged().whole.count()) == bool(whole)
    assert want and values(cut.splits(), *columns) == want


def test_scenarios_share_a_batch(spark, tables):
    runs = [(scenario(name="a"), tables), (scenario(name="b"), tables), (scenario(name="c", aqm="CAMX"), tables)]
    results = run_scenarios(spark, runs, with_report=False)
    assert values(results.summary(), "scenario_id", "profiles") == [("a", 2), ("b", 2), ("c", 2)]
    with pytest.raises(SpeciationError, match="differ"):
        run_scenarios(spark, [runs[0], runs[0]])


def test_report_and_gate(spark, tables, toxics):
    results = speciate(spark, scenario(), tables)
    found = {(r["check"], r["profile_id"], r["specie_id"]) for r in results.gate().report.collect()}
    assert ("missing_mw", "G1", "3") in found
    assert ("tolerance", "G2", None) in found
    assert ("unmapped_in_profiles", None, "4") in found
    assert ("unmapped_species", None, "3") in found
    no_ole = tables.with_(carbons=tables.carbons.where("aqm_poll <> 'OLE'"))
    with pytest.raises(SpeciationError, match="carbon"):
        speciate(spark, scenario(), no_ole).gate()
    missing = tables.with_(toxics=toxics.where("specie_id <> '2'"))
    with pytest.raises(SpeciationError, match="toxics list"):
        speciate(spark, scenario("INTEGRATE"), missing).gate()
    wide = tables.with_(invtable=tables.invtable.withColumn("eminv_poll", F.concat("eminv_poll", F.lit("_LONG_NAME"))))
    with pytest.raises(SpeciationError, match="too long"):
        speciate(spark, scenario(), wide).gate()
    massless = tables.with_(toxics=toxics, species=tables.species.withColumn("volatile_mw", F.expr("if(specie_id = '2', 0, volatile_mw)")))
    with pytest.raises(SpeciationError, match="molecular weight"):
        speciate(spark, scenario("INTEGRATE"), massless).gate()


def test_toxics_are_ignored_by_plain_runs(spark, tables, toxics):
    results = speciate(spark, scenario(), tables.with_(toxics=toxics))
    assert results.report.where("check = 'ignored_toxics'").count() == 3
    assert results.splits.where("aqm_poll like '%_T'").count() == 0

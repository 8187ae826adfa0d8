import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import values
from emisplit import Scenario, SpeciationError, Tables, bridge, staging
from emisplit.operators import mechanism, outputs
from emisplit.operators.volatility import volatility_class
from emisplit.plans.speciation import Batch, run_scenarios, speciate
from emisplit.sinks import text

SPLITS = (
    "scenario_id string, profile_id string, eminv_poll string, aqm_poll string, split_factor decimal(15,10), "
    "divisor decimal(12,8), mass_fraction decimal(15,10)"
)
SF = "/root/testdata/sf0.001"


def _line(rows):
    return [r["line"] for r in rows.orderBy("section", "key1", "key2", "key3").collect()]


def test_split_lines(table):
    rows = table(
        [("s", "0001", "TOG", "PAR", 0.5, 14.5, 0.5), ("s", "0001", "TOG", "OLE", 0.0012345678, 28, 0.0012345678)]
        + [("s", None, "TOG", "ZERO", 0, 1, 0)],
        SPLITS,
    )
    assert _line(text.split_lines(rows)) == [
        "                     TOG                  ZERO       0.000000e+00     1.000000 0.000000e+00",
        "0001                 TOG                  OLE        1.234568e-03    28.000000 1.234568e-03",
        "0001                 TOG                  PAR            0.500000    14.500000     0.500000",
    ]


def test_conversion_and_volatility_lines(table):
    rows = table(
        [("s", "VOC", "TOG", "0001", 1.25)],
        "scenario_id string, from_specie string, to_specie string, profile_id string, cnv_factor decimal(15,10)",
    )
    assert _line(text.conversion_lines(rows)) == ["VOC                  TOG                  0001                   1.25000000 "]
    classes = table([("s", "007", "name", "VOC")], "scenario_id string, specie_id string, specie_name string, voc_class string")
    assert _line(text.volatility_lines(classes)) == ["7\tname\tVOC"]


def test_volatility_classes(table):
    rows = table(
        [("a", "", 100, -99), ("b", "", 100, 0), ("c", "", 100, 1e-10), ("d", "", 100, 1), ("e", "", None, 1), ("f", "", 100, None)],
        "specie_id string, specie_name string, molecular_weight decimal(20,12), vp_epi decimal(20,12)",
    )
    assert values(volatility_class(rows), "specie_id", "voc_class") == [
        ("a", " "),
        ("b", "SVOCN1"),
        ("c", "SVOCN1"),
        ("d", "IVOCP5"),
        ("e", "VOC"),
        ("f", " "),
    ]
    bad = table([("x", "", 0, 1)], "specie_id string, specie_name string, molecular_weight decimal(20,12), vp_epi decimal(20,12)")
    with pytest.raises(Exception, match="not positive"):
        volatility_class(bad).collect()


def test_static_rename_and_unknown(spark, table):
    static = table(
        [("0000", "CO", "CO", 1, 28, 1, " "), ("0000", "X", "A", 1, 1, 1, "CMAQ"), ("0000", "X", "B", 1, 1, 1, "CAMX"), ("0000", "X", "C", 1, 1, 1, "")],
        "profile_id string, eminv_poll string, aqm_poll string, split_factor decimal(20,10), divisor decimal(20,10), "
        "mass_fraction decimal(20,10), aq_model string",
    )
    renames = table(
        [("CMAQ", "M", "A", "A2"), ("CMAQ", "OTHER", "CO", "C2"), ("CMAQ", "M", "A2", "A3")],
        "aq_model string, mechanism string, eminv_poll string, aqm_poll string",
    )
    run = Scenario("r", mech_basis="m", aqm="cmaq", output="STATIC")
    splits = speciate(spark, run, Tables(static=static, rename_species=renames)).gate().splits
    assert values(splits, "eminv_poll", "aqm_poll") == [("CO", "CO"), ("X", "A2")]


def test_rename_collision_stops_the_run(spark, table):
    static = table(
        [("0000", "X", "A", 1, 1, 1, " "), ("0000", "X", "B", 1, 1, 1, " ")],
        "profile_id string, eminv_poll string, aqm_poll string, split_factor decimal(20,10), divisor decimal(20,10), "
        "mass_fraction decimal(20,10), aq_model string",
    )
    renames = table([("CMAQ", "M", "A", "B")], "aq_model string, mechanism string, eminv_poll string, aqm_poll string")
    run = Scenario("r", mech_basis="M", aqm="CMAQ", output="STATIC")
    with pytest.raises(SpeciationError, match="duplicate key"):
        speciate(spark, run, Tables(static=static, rename_species=renames)).gate()


def test_drop_unknown(table):
    rows = table([("a", "1", "TOG", "UNK", 1, 1, 1), ("b", "1", "TOG", "UNK", 1, 1, 1), ("a", "1", "TOG", "PAR", 1, 1, 1)], SPLITS)
    flags = table([("a", "N"), ("b", None)], "scenario_id string, nonsoaflag string")
    assert values(outputs.drop_unknown(rows, flags), "scenario_id", "aqm_poll") == [("a", "PAR"), ("b", "UNK")]


def test_text_files_of_a_run(spark, tmp_path):
    tables = bridge.gas_tables(spark, SF).with_(
        toxics=bridge.toxics(spark, SF), metadata=bridge.metadata(spark), gas_process=bridge.gas_process(spark, SF)
    )
    run = Scenario("run", mech_basis="M_A", run_type="INTEGRATE", aqm="CMAQ", output="VOC", proc_file="modes.csv")
    out = str(tmp_path / "out")
    run = replace(run, cnv_out=f"{out}/chosen")
    results = speciate(spark, run, tables)
    text.write_outputs(results, out)

    def read(name):
        folder = f"{out}/{name}"
        parts = sorted(f for f in os.listdir(folder) if f.startswith("part"))
        return [line for f in parts for line in open(os.path.join(folder, f)).read().splitlines()]

    gspro = read("gspro/scenario_id=run")
    header = [line for line in gspro if line.startswith("#") and not line.startswith("#NHAP")]
    names = [line for line in gspro if line.startswith("#NHAP")]
    body = [line for line in gspro if not line.startswith("#")]
    assert gspro == header + names + body
    assert [h.split()[0] for h in header] == sorted(h.split()[0] for h in header)
    assert any(h.startswith("#PROCESS ") and "modes.csv" in h for h in header)
    assert any(h.startswith("#PROFILES ") and "Not Applicable" in h for h in header)
    assert len(body) == results.splits.count()
    assert [b[:52] for b in body] == sorted(b[:52] for b in body)
    assert len([g for g in read("chosen") if not g.startswith("#")]) == results.conversions.count()
    assert len(read("volatility/scenario_id=run")) == tables.species.count()
    text.write_tables(results, str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables" / "splits")).count() == len(body)


def test_targets_change_together_or_not_at_all(spark, table, tmp_path):
    rows = [(s, f"{i:04d}", "TOG", "PAR", 0.5, 14.5, 0.5) for s in ("a", "b:1", "c") for i in range(5)]
    lines = text.split_lines(table(rows, SPLITS)).select(text._LINE_COLUMNS)
    out, own = str(tmp_path / "gspro"), str(tmp_path / "own" / "b")
    os.makedirs(own)
    (tmp_path / "own" / "b" / "old").write_text("old")

    def seen():
        return {os.path.relpath(d, tmp_path): sorted(f for f in files if not f.startswith((".", "_"))) for d, _, files in os.walk(tmp_path) if files}

    written = text.LineFiles(lines, out, {"b:1": own})
    assert written.data == 15 and seen()["own/b"] == ["old"] and not os.path.exists(out)
    written.commit()
    after = seen()
    assert set(after) == {"own/b", "gspro/scenario_id=a", "gspro/scenario_id=c"} and "old" not in after["own/b"]
    assert sum(len(open(tmp_path / "own/b" / f).read().splitlines()) for f in after["own/b"]) == 5
    dropped = text.LineFiles(lines, out)
    dropped.drop()
    assert seen() == after


def test_lines_are_made_once_for_their_sort(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(line):
        made.add(1)
        return line

    spell = F.udf(counted, "string")
    # Few rows in many parts and most in one: the sort looks at that part once more.
    few = spark.range(0, 20, 1, 10).select((F.col("id") + 10_000).alias("id"))
    rows = few.union(spark.range(0, 3000, 1, 1)).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("key"))
    lines = rows.select(F.lit("a").alias("scenario_id"), F.lit(2).alias("section"), F.col("key").alias("key1"), *[F.lit("").alias(k) for k in ("key2", "key3")], spell("key").alias("line"))
    text.write_lines(lines, str(tmp_path / "out"))
    assert made.value == 3020
    parts = sorted(f for f in os.listdir(tmp_path / "out" / "scenario_id=a") if f.startswith("part-"))
    got = [line for part in parts for line in open(tmp_path / "out" / "scenario_id=a" / part).read().splitlines()]
    assert len(got) == 3020 and got == sorted(got)


def test_a_run_without_conversions_leaves_no_file(spark, tmp_path):
    tables = bridge.gas_tables(spark, SF)
    tables = tables.with_(profile_weights=tables.profile_weights.where("false"), metadata=bridge.metadata(spark))
    results = speciate(spark, Scenario("run", mech_basis="M_A", run_type="CRITERIA", aqm="CMAQ", output="VOC"), tables)
    with pytest.raises(SpeciationError, match="conversion factors"):
        text.write_outputs(results, str(tmp_path / "out"))
    assert [f for _, _, files in os.walk(tmp_path) for f in files if not f.startswith(".")] == []


def test_pm_metadata(spark, table):
    meta = table(
        [("AQM", "Not Applicable"), ("RUN_TYPE", "x"), ("CAMX_FCRS", "fcrs.lst"), ("STATIC", "static.csv")],
        "keyword string, dataval string",
    )
    from emisplit.plans.metadata import metadata_rows

    run = Scenario("r", mech_basis="AE6", run_type="CRITERIA", aqm="CAMx", output="PM")
    batch = Batch(spark, (run,), Tables())
    rows = metadata_rows(meta, batch.runs, batch.flags)
    got = dict(values(rows, "keyword", "dataval"))
    assert got["AQM"] == "CAMX" and got["CAMX_FCRS"] == "fcrs.lst" and got["STATIC"] == "Not Applicable"
    assert got["NOTE"].startswith("PM CAMx CF")


def test_empty_sink_raises(table):
    with pytest.raises(SpeciationError, match="no data"):
        text.assert_not_empty(table([], SPLITS), "splits")


def test_conversion_files_depend_on_output():
    assert Scenario("a").writes_conversions and Scenario("a", output="VOC").writes_conversions
    assert not Scenario("a", output="VOC,STATIC").writes_conversions
    assert not Scenario("a", output="VOC", run_type="haplist").writes_conversions


def test_weights_are_written_once_and_nothing_else_runs(spark):
    """Two jobs' worth of staging (sizes, weights) for gas and for particulates, whatever the number of runs."""
    gas = bridge.gas_tables(spark, SF)
    integrated = gas.with_(toxics=bridge.toxics(spark, SF))
    kinds = ["CRITERIA", "VBS", "NOINTEGRATE", "INTEGRATE"]
    runs = [(Scenario(kind, mech_basis="M_A", run_type=kind, aqm="CMAQ", output="VOC"), integrated if "INT" in kind else gas) for kind in kinds]
    pm = [(Scenario(f"pm{i}", mech_basis=m, run_type="CRITERIA", aqm="CMAQ", output="PM"), bridge.pm_tables(spark, SF)) for i, m in enumerate(("AE6", "AE8"))]
    made = []
    real = staging.staged

    def counting(*args, **kwargs):
        made.append(args[3])
        return real(*args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("emisplit.plans.speciation.staged", counting)
        results = run_scenarios(spark, [*runs, *pm], with_report=False)
        assert made == ["gas_weights", "pm_weights"]
        spark.sparkContext.setJobGroup("planning", "")
        try:
            assert results.splits and results.conversions
            assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
        finally:
            spark.sparkContext.setJobGroup("tests", "")
    assert results.summary().count() == 6


def test_many_runs_have_the_plan_of_few(spark):
    def nodes(n):
        tables = bridge.gas_tables(spark, SF).with_(metadata=bridge.metadata(spark))
        runs = [(Scenario(f"run{i}", mech_basis="M_A", run_type="CRITERIA", aqm="CMAQ", output="VOC"), tables) for i in range(n)]
        results = run_scenarios(spark, runs)
        tables = (results.splits, results.conversions, results.metadata, results.report, text.gscnv_lines(results))
        plans = [t._jdf.queryExecution().optimizedPlan() for t in tables]
        return [p.treeString().count("\n") for p in plans], [p.expressions().size() for p in plans]

    assert nodes(3) == nodes(300)


def test_equal_tables_share_a_plan(spark):
    first, again, other = (bridge.gas_tables(spark, SF) for _ in range(3))
    assert first.same(again) and not first.same(other.with_(species=other.species.where("volatile_mw > 0")))
    assert not first.same(other.with_(carbons=None))


def test_names_that_differ_in_case_give_one_flag(table):
    runs = table([("r", "CB6")], "scenario_id string, mechanism string")
    named = table(
        [("cb6", "N", "low"), ("CB6", "Y", "high"), ("Cb6", None, None)],
        "mechanism string, nonsoaflag string, comment string",
    )
    for exact in (False, True):
        flags = mechanism.scenario_flags(runs, named, case_insensitive=exact)
        assert values(flags, "scenario_id", "nonsoaflag", "comment") == [("r", "Y", "high")]

import pytest
from pyspark.sql import functions as F

from conftest import values
from emisplit.errors import SpeciationError
from emisplit.operators import quality
from emisplit.sources import control, files, lines
from emisplit.plans.scenario import Scenario
from emisplit.plans.tables import Tables


def _write(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_clean_file_keeps_lines(spark, tmp_path):
    source = _write(tmp_path / "raw.txt", b"a\x00b\xc3\xa9c\td\r\nnext\x7f line\n")
    files.clean_file(spark, source, str(tmp_path / "clean"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "clean")).collect()) == ["abcd", "next line"]


def test_csv_quotes_comments_and_blanks(spark, tmp_path):
    path = _write(tmp_path / "o2m.csv", '# id,symbol,ratio\n695,Ag, 0.074\n"292","A""l",0.8890004\n')
    rows = files.read_table(spark, path, "o2m_ratios")
    assert values(rows, "specie_id", "symbol", "o2m_ratio") == [("292", "Al", 0.889), ("695", "Ag", 0.074)]


def test_csv_empty_text_stays_empty(spark, tmp_path):
    path = _write(tmp_path / "pm.csv", "AE6,626,POC,N,N\nAE6,,PMOTHR,N,Y\n")
    rows = files.read_table(spark, path, "pm_mechanism")
    assert values(rows, "specie_id", "aqm_poll", "compute") == [("", "PMOTHR", True), ("626", "POC", False)]


@pytest.mark.parametrize("text", ["695,Ag\n", "695,Ag,0.1,more\n", "695,Ag,\n", "695,Ag,x\n"])
def test_csv_bad_row_fails_the_read(spark, tmp_path, text):
    path = _write(tmp_path / "bad.csv", "292,Al,0.889\n" + text)
    with pytest.raises(Exception):
        files.read_table(spark, path, "o2m_ratios").collect()


def test_invtable_fixed_width(spark, tmp_path):
    widths = (12, 4, 17, 6, 2, 2, 6, 2, 2, 2, 2, 4, 17, 41, 40)
    fields = ["BENZENE", "EXH", "71432", "302", "", "Y", "1.0", "V", "Y", "N", "", "", "tons", "a benzene", "x"]
    line = "".join(f.ljust(w) for f, w in zip(fields, widths))
    path = _write(tmp_path / "inv.txt", "#comment\n" + line + "\nSHORT\n")
    rows = files.read_table(spark, path, "invtable")
    assert values(rows, "eminv_poll", "mode", "specie_id", "voc", "description") == [
        ("BENZENE", "EXH", "302", "V", "a benzene"),
        ("SHORT", "", "", "", ""),
    ]


def test_load_checks_keys_and_records_sources(spark, tmp_path):
    carbons = _write(tmp_path / "c.csv", "M,A,1\nM,B,2\n")
    loaded = files.load(spark, {"carbons": carbons})
    assert ("CARBONS", carbons[1:]) in values(loaded["metadata"], "keyword", "dataval")
    _write(tmp_path / "c.csv", "M,A,1\nM,A,2\n")
    with pytest.raises(SpeciationError, match="duplicate key"):
        files.load(spark, {"carbons": carbons})


def test_unique_ignores_null_key_parts(table):
    rows = table([("p", None), ("p", None)], "a string, b string")
    assert files.assert_unique(rows, ["a", "b"]) is rows


def test_all_duplicates_are_counted_and_reported(table):
    rows = table([(f"{i // 2:02d}",) for i in range(60)] + [("x",)], "a string")
    with pytest.raises(SpeciationError) as raised:
        files.assert_unique(rows, ["a"], "t")
    assert raised.value.rows[0]["findings"] == 30 and raised.value.rows[0]["a"] == "00"
    assert raised.value.report.count() == 30


def test_a_bad_last_line_leaves_no_table_and_a_report_of_all(spark, tmp_path):
    carbons = _write(tmp_path / "c.csv", "# head\nM,A,1\nM,B,x\nM,C,2\n" + "".join(f"M,D{i},3\n" for i in range(5000)) + "M,E\n")
    species = _write(tmp_path / "camx.csv", "1\n2\n1\n")
    paths = {"carbons": carbons, "camx_fcrs": species, "o2m_ratios": _write(tmp_path / "o.csv", "1,Ag,0.5\n")}
    folder = tmp_path / "loaded"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        with pytest.raises(SpeciationError, match="nothing loaded") as raised:
            files.load(spark, paths, folder=str(folder))
        found = sorted(tuple(r) for r in raised.value.report.fillna(-1).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [
        ("camx_fcrs", -1, "2 rows with one key", "1"),
        ("carbons", 3, "num_carbons is no decimal(5,2): x", "M,B,x"),
        ("carbons", 5005, "expected 3 fields", "M,E"),
    ]
    assert not folder.exists()
    assert {r["table"]: r["findings"] for r in raised.value.rows} == {"carbons": 2, "camx_fcrs": 1}
    _write(tmp_path / "c.csv", "M,A,1\n")
    _write(tmp_path / "camx.csv", "1\n2\n")
    loaded = files.load(spark, paths, folder=str(folder))
    assert sorted(p.name for p in folder.iterdir()) == ["camx_fcrs", "carbons", "o2m_ratios"]
    assert values(loaded["carbons"], "aqm_poll", "num_carbons") == [("A", 1.0)]
    assert spark.read.parquet(str(folder / "camx_fcrs")).count() == 2


def test_key_check_of_a_loaded_table_needs_no_shuffle(spark, tmp_path):
    carbons = _write(tmp_path / "c.csv", "M,A,1\nM,B,2\n")
    loaded = files.load(spark, {"carbons": carbons})["carbons"]
    plan = files.duplicates(loaded, ["mechanism", "aqm_poll"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount" in plan


@pytest.mark.parametrize("text", ["695,Ag", "695,Ag,0.1,more", "695,Ag,", "695,Ag,x", '"695,Ag,0.1'])
def test_judged_lines_agree_with_the_strict_parser(spark, text):
    given = spark.createDataFrame([(text,), ("# comment",), (' "7" ,"A, b", 0.5',)], "value string")
    judged = {r["value"]: r for r in lines.judged_lines(given, "o2m_ratios").collect()}
    assert judged[text]["problem"] and len(judged) == 2
    with pytest.raises(Exception):
        lines.parse_csv(given.where(F.col("value") == text), "o2m_ratios").collect()
    good = given.where(F.col("value").startswith(" "))
    strict = lines.parse_csv(good, "o2m_ratios")
    assert lines.judged_lines(good, "o2m_ratios").select(strict.columns).collect() == strict.collect()


def test_scenario_table_and_its_checks(spark):
    text = ["AQM,CMAQ", "OUTPUT,PM", "run_type,haplist"]
    rows = spark.createDataFrame([("r1", t) for t in text] + [("r2", "OUTPUT,voc"), ("r2", "AQM, "), ("r3", "AQM,x")], "run_name string, value string")
    runs = control.scenario_table(control.parse_control(rows))
    assert values(quality.missing_settings(runs), "scenario_id", "setting") == [
        ("r1", "MECH_BASIS"), ("r2", "AQM"), ("r3", "MECH_BASIS"), ("r3", "RUN_TYPE"),
    ]
    assert values(quality.unsupported_pm_runs(runs), "scenario_id", "kind") == [("r1", "HAPLIST")]
    assert [r["check"] for r in quality.check_pm_run_type(runs).collect()] == ["pm_run_type"]
    assert quality.check_required(runs).count() == 4
    assert values(quality.empty_outputs(runs, runs.where("scenario_id = 'r2'")), "scenario_id") == [("r1",), ("r3",)]


def test_plain_split_has_no_quoting(spark, tmp_path):
    rows = files.read_primary(spark, _write(tmp_path / "p.csv", '"BENZENE",BENZ_PRI, 0.5,Y\n#X,Y,1,N\n'))
    assert values(rows, "aqminv_poll", "aqm_add", "split_factor", "writeflag") == [
        ("#X", "Y", 1.0, "N"),
        ("BENZENE", "BENZ_PRI", 0.5, "Y"),
    ]
    with pytest.raises(Exception, match="expected 3 fields"):
        files.read_toxics(spark, _write(tmp_path / "t.csv", "CMAQ,1\n")).collect()


def test_process_modes(spark, tmp_path):
    text = '#0;"9";"EXH__VOC"\n0;"8750";"EXH__VOC"\n0;"8750";"EXH__VOC"\n0;"8751";"EVP__TOG"\n0;"1";"EXH__NOX"\n0;"2";"VOC"\n'
    rows = files.read_process_modes(spark, _write(tmp_path / "gsref.txt", text))
    assert [tuple(r) for r in rows.collect()] == [("8750", "EXH"), ("8751", "EVP")]


def test_control_lines(spark):
    text = ["# x", "", "mech_basis,CB6 ", " Run_type , criteria", "AQM,CMAQ,more", "unknown,1", "TOLERANCE,2.5"]
    rows = spark.createDataFrame([("r1", t) for t in text] + [("r2", "AQM,CAMx")], "run_name string, value string")
    first, second = control.scenarios_from(control.parse_control(rows))
    assert (first.mechanism, first.kind, first.model, first.tolerance_pct) == ("CB6", "CRITERIA", "CMAQ", 2.5)
    assert (second.run_name, second.model, second.kind, second.tolerance_pct) == ("r2", "CAMX", None, 5.0)


def test_a_run_without_settings_is_a_run(spark):
    rows = spark.createDataFrame([("r1", "# AQM,CMAQ"), ("r1", "other,1"), ("r1", ""), ("r2", "AQM,CMAQ")], "run_name string, value string")
    runs = control.parse_control(rows)
    assert [(s.run_name, s.model) for s in control.scenarios_from(runs)] == [("r1", None), ("r2", "CMAQ")]
    assert values(quality.missing_settings(control.scenario_table(runs)).where("setting = 'AQM'"), "scenario_id") == [("r1",)]


def test_control_lines_are_sorted_after_they_are_dealt_out_by_run(spark):
    lines = [(f"r{i % 7}", i, f"AQM,{i}") for i in range(50)] + [("r0", 60, "TOLERANCE,2"), (None, 61, "AQM,none"), ("r8", 62, "# AQM,x")]
    runs = control.parse_control(spark.createDataFrame(lines, "run_name string, position int, value string"))
    got = {r["run_name"]: (r["AQM"], r["TOLERANCE"]) for r in runs.collect()}
    assert got == {f"r{i}": (str(i), "2" if i == 0 else None) for i in range(7)} | {None: ("none", None), "r8": (None, None)}
    plan = runs._jdf.queryExecution().sparkPlan().toString()
    # Below the only shuffle nothing sorts or aggregates.
    above, below = plan.split("Exchange hashpartitioning(run_name", 1)
    assert "Aggregate" in above and "Aggregate" not in below and "Exchange" not in below


def test_control_and_user_files(spark, tmp_path):
    toxics = _write(tmp_path / "tox.csv", "CMAQ,1,A\nCMAQ,2,B\n")
    weights = _write(tmp_path / "wts.csv", "G,1,50\nG,2,50\n")
    paths = {
        "one": _write(tmp_path / "c1", f"AQM,CMAQ\nTOX_FILE,{toxics}\nPRO_FILE,{weights}\n"),
        "two": _write(tmp_path / "c2", "AQM,CAMx\nTOLERANCE,5\nTOLERANCE,10\nAQM,ADMS\n"),
    }
    one, two = control.read_scenarios(spark, paths)
    assert (two.model, two.tolerance_pct) == ("CAMX", 5.0)  # the first value of a repeated keyword
    tables = control.with_user_files(spark, one, Tables())
    assert values(tables.toxics, "specie_id", "aqm_poll") == [("1", "A"), ("2", "B")]
    assert values(tables.user_profile_wts, "specie_id", "percent") == [("1", 50.0), ("2", 50.0)]
    assert control.with_user_files(spark, two, Tables()) == Tables()
    _write(tmp_path / "tox.csv", "CMAQ,1,A\nCMAQ,1,A\n")
    with pytest.raises(SpeciationError, match="duplicate key"):
        control.with_user_files(spark, one, Tables())


def test_environment():
    scenario = control.scenario_from_environment(" r ", {"AQM": " CMAQ ", "OUTPUT": "", "OTHER": "x"})
    assert scenario == Scenario("r", aqm="CMAQ")


def test_required_settings():
    Scenario("a", aqm="CMAQ", output="STATIC").check_required()
    with pytest.raises(SpeciationError, match="AQM"):
        Scenario("a", output="STATIC").check_required()
    with pytest.raises(SpeciationError, match="RUN_TYPE"):
        Scenario("a", aqm="CMAQ", mech_basis="M").check_required()
    with pytest.raises(SpeciationError, match="MECH_BASIS"):
        Scenario("a", aqm="CMAQ", output="PM").check_required()
    with pytest.raises(SpeciationError, match="not supported for PM"):
        Scenario("a", aqm="CMAQ", output="PM", mech_basis="AE6").check_pm_run_type()


def test_clean_text_column(table):
    rows = table([("a\tb\nç d",)], "text string").select(lines.clean_text(F.col("text")))
    assert rows.first()[0] == "ab\n d"

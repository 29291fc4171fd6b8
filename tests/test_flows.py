"""Both flows end to end on files in a temporary folder, preflight, sources and sinks."""

import pytest
from pyspark.sql import functions as F

from kelpline import cli, contracts, rules
from kelpline.config import PrimaryConfig, RetrievalConfig, SecondaryConfig
from kelpline.functions.embed import FunctionEmbedder
from kelpline.plans import preflight, primary, secondary
from kelpline.sources import files, sinks, xlsx
from kelpline.streaming import intake
from tests.test_operators import keyword

YEARS = ("2020", "2021", "2022", "2023", "2024")


@pytest.fixture
def data(tmp_path):
    for y in YEARS:
        (tmp_path / f"{y}_c").mkdir()
        (tmp_path / f"{y}_c" / f"Cook_{y}.csv").write_text("chrg_code,chrg_desc,chrg_type_violent,check\n13-1,Assault with weapon,1,x\n487,Theft of vehicle,0,x\n")
    (tmp_path / "2025_d").mkdir()
    new = [("13-1", "ASSAULT WITH WEAPON", 0), ("99", "THEFT OF VEHICLES", 0), ("X1", "MURDER PLOT ABROAD", None), ("487", "", 0), ("Q9", None, 0), ("5", "OLD ROW", 1), ("", "", 0)]
    xlsx.write_workbook(str(tmp_path / "2025_d" / "Cook new.xlsx"), {"Other": (["a"], []), "Sheet1": (["chrg_code", "chrg_desc", "charge_key"], new)})
    return tmp_path


def test_primary_then_preflight_codes(spark, data):
    cfg = PrimaryConfig("Cook", "2025", min_class_count=99)
    out = data / "out"
    run = primary.run(spark, str(data), str(out), cfg, FunctionEmbedder(lambda: keyword))
    got = {r.input_chrg_code: r for r in run.results.collect()}
    assert {k: (r.match_method, r.needs_human_review) for k, r in got.items()} == {
        "13-1": ("exact", False), "99": ("fuzzy", False), "X1": ("embedding", True), "487": ("exact", False), "Q9": ("code_only_unmatched", True),
    }
    assert got["Q9"].input_chrg_desc == primary.NO_TEXT and got["99"].chrg_type_violent == "0"
    assert run.summary.first().asDict() == {"total": 5, "auto_classified": 3, "needs_review": 2, "automation_rate": 60.0}
    key = xlsx.read_xlsx(spark, str(run.path), "Charge Key").collect()
    assert {(r.chrg_code, r.chrg_desc) for r in key} == {("13-1", "ASSAULT WITH WEAPON"), ("487", "THEFT OF VEHICLE"), ("99", "THEFT OF VEHICLES")}
    assert xlsx.read_xlsx(spark, str(run.path), "Charge to be Reviewed").count() == 2
    report = preflight.check_primary(data, out, cfg, spark)
    assert report.ok and not report.warnings

    codes = lambda r: {i.code for i in r.issues}
    assert codes(preflight.check_primary(data, out, PrimaryConfig("Nowhere", "2025"), spark)) == {"invalid_config"}
    assert codes(preflight.check_primary(data / "no", run.path, cfg, spark)) == {"output_not_directory", "data_dir_missing"}
    assert codes(preflight.check_primary(data, data / "o2", PrimaryConfig("Harris", "2025"), spark)) == {"reference_missing", "diagnostic_missing", "starting_key_missing"}
    (data / "2022_c" / "Cook_2022.csv").write_text("code\n1\n")
    (data / "2021_c" / "Cook_2021.csv").unlink()
    bad = preflight.check_primary(data, out, cfg, spark)
    assert codes(bad) == {"missing_columns", "reference_years_missing"}
    with pytest.raises(preflight.PreflightError):
        bad.raise_for_errors()


def test_secondary(spark, tmp_path):
    for y in ("2020", "2021", "2022", "2023"):
        (tmp_path / f"{y}_c").mkdir()
        (tmp_path / f"{y}_c" / f"Lucas_{y}.csv").write_text("chrg_code,chrg_desc,chrg_type_violent\nA,ASSAULT WITH WEAPON,1\n")
    key = [("Lucas", "A", "ASSAULT WITH WEAPON", 1, "F"), ("Lucas", "B", "THEFT OF VEHICLE", 0, "M")]
    (tmp_path / "out").mkdir()
    xlsx.write_workbook(str(files.intermediary(tmp_path / "out", "Lucas", "2025")), {"Charge Key": (["site", "chrg_code", "chrg_desc", "chrg_type_violent", "chrg_sev"], key)})
    (tmp_path / "2025_court_d").mkdir()
    (tmp_path / "2025_court_d" / "Lucas.csv").write_text("chrg_code,chrg_desc,charge_key\nJ1,Assault with weapon,0\nJ2,THEFT OF VEHICLE,0\nJ3,ab,0\n")
    run = secondary.run(spark, str(tmp_path), str(tmp_path / "out"), SecondaryConfig("Lucas", "2025", min_class_count=99), FunctionEmbedder(lambda: keyword))
    assert run.summary.first().asDict() == {"total": 2, "confident": 2, "ensemble_resolved": 0, "needs_review": 0, "automation_rate": 100.0}
    rows = {r.court_chrg_code: r for r in xlsx.read_xlsx(spark, str(run.path), "confident").collect()}
    assert rows["J1"].matched_jail_chrg_code == "A" and rows["J1"].match_method == "exact" and rows["J2"].chrg_sev == "M"
    report = preflight.check_secondary(tmp_path, tmp_path / "none", SecondaryConfig("Spokane", "2025"), spark)
    assert {i.code for i in report.issues} == {"finalized_jail_key_missing", "court_diagnostic_missing", "training_keys_missing"}


def test_csv_encodings_and_discovery(spark, tmp_path):
    (tmp_path / "NewOrleans_b.CSV").write_bytes("chrg_code,chrg_desc,chrg_type_FTA\n007,Caf\xe9 \x93x\x94,1\n".encode("latin-1"))
    (tmp_path / "New_Orleans_a.csv").write_text("chrg_code,chrg_desc\nNA,Café\n", encoding="utf-8")
    (tmp_path / "New Orleans.csv").write_text("a\n")
    (tmp_path / "NewOrleans.txt").write_text("a\n")
    found = files.find_files(tmp_path, "New Orleans")
    assert [p.name for p in found] == ["NewOrleans_b.CSV", "New_Orleans_a.csv"] and files.find_files(tmp_path / "no", "Cook") == []
    old = files.read_table(spark, found[0])
    assert old.first().chrg_desc == "Café “x”" and old.columns[2] == "chrg_type_fta" and old.first().chrg_code == "007"
    new = files.preprocess(files.read_table(spark, found[1]), "New Orleans").first()
    assert (new.chrg_code, new.chrg_desc) == ("", "CAFÉ")


def test_workbook_round_trip(spark, tmp_path):
    rows = [("a<&>\"", 1, 2.5, None, True), (" pad ", None, 0, "ü\n", False)]
    path = tmp_path / "b.xlsx"
    xlsx.write_workbook(str(path), {"One": (["t", "i", "f", "n", "b"], rows), "Two": (["x"], [])})
    assert [tuple(r) for r in xlsx.read_xlsx(spark, str(path), "One").collect()] == [("a<&>\"", "1", "2.5", None, "1"), (" pad ", None, "0", "ü\n", "0")]
    assert xlsx.read_xlsx(spark, str(path), 1).count() == 0
    with pytest.raises(Exception, match="no sheet"):
        xlsx.read_xlsx(spark, str(path), "Three").count()


def test_rules_contracts_and_settings():
    assert len(rules.PRIMARY_SITES) == 16 and len(rules.SECONDARY_SITES) == 8 and len(contracts.CANONICAL) == 41
    assert rules.rule_for("Buncombe").drop_blank_codes and rules.rule_for("Spokane").lower_descriptions
    assert rules.aliases("St. Louis") == ("StLouis", "St_Louis") and rules.aliases("Cook") == ("Cook",)
    assert contracts.attributes(["a", "chrg_type_x", "chrg_ibr_code", "chrg_type_x"]) == ["chrg_ibr_code", "chrg_type_x"]
    audit = contracts.audit(["chrg_type_dui", "chrg_type_local"])
    assert audit.extra == ("chrg_type_local",) and len(audit.missing) == 40
    assert PrimaryConfig("Cook", "2025").reference_years() == YEARS and SecondaryConfig("Lucas", "2025").reference_years() == YEARS[:4]
    assert PrimaryConfig("Cook").target_year == SecondaryConfig("Lucas").target_year == "2026"
    for bad in (lambda: PrimaryConfig("Cook", similarity=2).validate(), lambda: RetrievalConfig(0, 0, 0, 0), lambda: RetrievalConfig(top_ks=()), lambda: RetrievalConfig(ngrams=(3, 2)), lambda: SecondaryConfig("Cook").validate()):
        with pytest.raises(ValueError):
            bad()
    assert cli.parser().parse_args(["primary", "--site", "Cook", "--data", "d", "--output", "o"]).fuzzy == 90.0


def test_sinks(spark, tmp_path):
    results = spark.createDataFrame([("1", "A", "1", "a", False, 0.9, "exact", False, 0), ("1", "A", "2", "b", False, 0.8, "fuzzy", False, 1), ("2", "B", None, "", True, 0.1, "embedding", True, 2)], "input_chrg_code string, input_chrg_desc string, matched_chrg_code string, matched_chrg_desc string, desc_derived boolean, similarity_score double, match_method string, needs_human_review boolean, result_seq long")
    key = spark.createDataFrame([("1", "A", "old"), ("9", "Z", "old")], "chrg_code string, chrg_desc string, chrg_type_x string")
    tables = sinks.primary_tables(results, key, "Cook", ["chrg_type_x"])
    assert [r.simiarity_score for r in tables["Charges added"].collect()] == [0.9]
    assert {(r.chrg_code, r.chrg_type_x) for r in tables["Charge Key"].collect()} == {("1", "old"), ("9", "old")}
    sinks.write_parquet(tables, f"file://{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t/charge_to_be_reviewed").count() == 1
    assert sinks.primary_summary(results.where("false")).first().automation_rate == 0.0


def test_streaming_intake(spark, tmp_path):
    ref = spark.createDataFrame([(1, 0, "A", "ASSAULT WITH WEAPON")], "ref_id long, ref_pos long, code string, desc string")
    rows = spark.createDataFrame([(1, "A", "ASSAULT WITH WEAPON", "2025-01-01 00:00:00"), (2, "A", "ASSAULT WITH WEAPON", "2025-01-01 00:01:00"), (3, "B", "SOMETHING ELSE", "2025-01-01 00:02:00")], "query_id long, code string, desc string, ts string").withColumn("ts", F.to_timestamp("ts"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = intake.deduplicated(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    got = []
    q = intake.matched(stream, ref, lambda df, n: got.extend(df.collect()), f"{tmp_path}/check")
    q.awaitTermination(120)
    assert sorted(r.method for r in got) == ["exact", "unmatched"]

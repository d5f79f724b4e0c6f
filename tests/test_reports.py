"""Extraction and staging, one case per behaviour of the documents."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from samples import doc, raw, rows
from vigilspark.plans import reports as R
from vigilspark.schemas import PAIR_COLUMNS, REPORT_COLUMNS, REPORT_DRUG_COLUMNS, REPORT_REACTION_COLUMNS


def test_report_id_paths(spark):
    docs = [doc("a"), doc(None, safetyreportid="b"), doc("x", safetyreportid="c"), doc(None),
            {"safetyreport": []}, {"other": 1}]
    assert rows(R.stage_reports(raw(spark, docs)), "report_id") == [("a",), ("b",), ("c",)]


def test_only_the_first_report_of_a_document_counts(spark):
    two = {"safetyreport": doc("a")["safetyreport"] + doc("b")["safetyreport"]}
    assert rows(R.stage_reports(raw(spark, [two])), "report_id") == [("a",)]


@pytest.mark.parametrize("text, date", [
    ("20240105", dt.date(2024, 1, 5)), ("2024-01-05", dt.date(2024, 1, 5)),
    ("20240231", None), ("", None), ("soon", None), (20240105, dt.date(2024, 1, 5)), (None, None)])
def test_received_date(spark, text, date):
    row = R.stage_reports(raw(spark, [doc("a", receivedate=text)])).first()
    assert row.received_date == date and row.reception_date is None


def test_reception_date_is_below_received_date(spark):
    row = R.stage_reports(raw(spark, [doc("a", receivedate={"receptiondate": "20240106"})])).first()
    assert (row.received_date, row.reception_date) == (None, dt.date(2024, 1, 6))


def test_typed_values(spark):
    d = doc("a", safetyreportversion="7", transmissiondate="20240107",
            primarysource=[{"reportercountry": "FR"}],
            patient={"age": [{"value": "45.555", "agedays": 16628, "ageyears": 45}], "sex": "2",
                     "onsetdate": ["2024-01-02"], "weight": [{"weight": 70.125}],
                     "height": [{"height": "171.25"}]})
    row = R.reports(R.stage_reports(raw(spark, [d]))).first()
    assert row.asDict() == {
        "report_id": "a", "received_date": dt.date(2024, 1, 5), "reception_date": None,
        "safety_report_version": 7, "transmission_date": dt.date(2024, 1, 7),
        "patient_age": Decimal("45.56"), "patient_age_days": 16628, "patient_age_years": 45,
        "patient_sex": 2, "reaction_onset_date": dt.date(2024, 1, 2),
        "patient_weight_kg": Decimal("70.13"), "patient_height_cm": Decimal("171.3"),
        "source_country": "FR", "src_ld_ts": dt.datetime(2024, 2, 1), "src_ld_date": dt.date(2024, 2, 1),
        "source_file": "f1.json"}


def test_misfits_are_null_and_listed_or_raise(spark):
    d = doc("a", safetyreportversion="1000", patient={"age": [{"value": "old"}], "onsetdate": ["x"]})
    table = raw(spark, [d, doc("b")])
    staged = R.stage_reports(table).filter("report_id = 'a'").first()
    assert (staged.safety_report_version, staged.patient_age, staged.reaction_onset_date) == (None,) * 3
    assert rows(R.cast_errors(table), "file_id", "column_name", "value") == [
        (1, "patient_age", "old"), (1, "reaction_onset_date", "x"), (1, "safety_report_version", "1000")]
    assert rows(R.cast_errors(table), "position") == [(None,)] * 3
    with pytest.raises(Exception, match="does not fit"):
        R.stage_reports(table, strict=True).collect()


def test_patient_that_is_an_object(spark):
    d = doc("a", ["x"], ["r"])
    d["safetyreport"][0]["patient"] = d["safetyreport"][0]["patient"][0]
    staged = R.stage_reports(raw(spark, [d]))
    row = staged.first()
    assert (row.report_id, row.patient_age, row.patient_sex) == ("a", None, None)
    assert R.report_drugs(staged).count() == R.report_reactions(staged).count() == 0


def test_drug_names(spark):
    drugs = [{"drgname": "n", "medicinalproduct": "m", "medicinalproductname": "l"},
             {"medicinalproduct": "m", "medicinalproductname": "l"}, {"medicinalproductname": "l"},
             {"activesubstancename": "s"}, {"drugdosage": "nothing"}, None, 5]
    got = R.report_drugs(R.stage_reports(raw(spark, [doc("a", drugs)])))
    assert rows(got, "report_drug_id", "drug_name", "active_substance_name", "drug_sequence") == [
        ("a-0", "n", None, 0), ("a-1", "m", None, 1), ("a-2", "l", None, 2), ("a-3", None, "s", 3)]
    assert got.columns == REPORT_DRUG_COLUMNS


def test_drug_fields(spark):
    drug = {"medicinalproduct": "m", "drgcode": [{"value": 12, "codingSystem": "c"}],
            "drugcharacterization": "3", "drugdosageform": "f", "drugdosage": "d",
            "drugadministrationroute": [{"routecode": "048"}], "drugauthorizationnumber": "A1",
            "drugindication": [{"value": "pain", "codingSystem": "i"}],
            "drugcumulativedose": [{"value": "1.005", "doseunit": "mg"}],
            "timeintervalunitofmeasure": "804"}
    r = R.report_drugs(R.stage_reports(raw(spark, [doc("a", [drug])]))).first()
    assert (r.drug_code, r.drug_coding_system, r.drug_characterization, r.drug_dosage_form,
            r.drug_dosage_text, r.route_code, r.authorization_number, r.drug_indication,
            r.indication_coding_system, r.cumulative_dose_value, r.cumulative_dose_unit,
            r.dose_time_unit, r.medicinal_product_name) == (
        "12", "c", 3, "f", "d", "048", "A1", "pain", "i", Decimal("1.01"), "mg", "804", "m")


def test_reactions(spark):
    reactions = ["r", {"reactionmeddrallt": "low"},
                 {"reactionmeddrapt": "q", "reactionmeddraversionpt": "24", "primarysourcereaction": "p",
                  "reactionmeddrallt": "t", "reactionoutcome": [{"codingSystem": "o", "value": "6"}]}]
    got = R.report_reactions(R.stage_reports(raw(spark, [doc("a", ["x"], reactions)])))
    assert got.columns == REPORT_REACTION_COLUMNS
    assert rows(got.drop("received_date", "src_ld_ts", "src_ld_date")) == [
        ("a-react-0", "a", None, None, "r", None, None, None, 0),
        ("a-react-2", "a", "24", "p", "q", "t", "o", 6, 2)]


def test_pairs(spark):
    staged = R.stage_reports(raw(spark, [doc("a", ["x", "x"], ["r"]), doc("b", ["y"], []), doc("c", [], ["q"])]))
    got = R.pairs_of_reports(staged)
    assert got.columns == PAIR_COLUMNS
    assert rows(got, "drug_reaction_pair_id", "drug_name", "reaction_term") == [
        ("a-a-0-a-react-0", "x", "r"), ("a-a-1-a-react-0", "x", "r")]


def test_newest_load_wins_with_its_own_children(spark):
    docs = [(doc("a", ["x", "y"], ["r"]), "2024-02-01"), (doc("a", ["z"], ["r"]), "2024-02-03"),
            (doc("a", ["w"], ["r"]), "2024-02-02")]
    staged = R.stage_reports(raw(spark, docs))
    assert rows(staged, "report_id", "source_file") == [("a", "f2.json")]
    assert rows(R.report_drugs(staged), "drug_name") == [("z",)]


def test_equal_load_times_go_to_the_higher_id(spark):
    staged = R.stage_reports(raw(spark, [doc("a", ["x"]), doc("a", ["y"])]))
    assert rows(R.report_drugs(staged), "drug_name") == [("y",)]


def test_join_raw_to_staged_keeps_one_version(spark):
    table = raw(spark, [(doc("a"), "2024-02-01"), (doc("a"), "2024-02-02"), (doc("b"), "2024-02-01"), doc(None)])
    joined = R.join_raw_to_staged(table, R.stage_reports(table))
    assert rows(joined, "report_id", "file_id") == [("a", 2), ("b", 3)]


def test_empty_arrays(spark):
    hollow = {"medicinalproduct": "x", "drgcode": [], "drugindication": [], "drugcumulativedose": [],
              "drugadministrationroute": []}
    docs = [doc("a", [hollow], [{"reactionmeddrapt": "r", "reactionoutcome": []}], primarysource=[],
                patient={"age": [], "onsetdate": [], "weight": [], "height": []}),
            {"safetyreport": [{"id": "b", "patient": []}]}]
    staged = R.stage_reports(raw(spark, docs), strict=True)
    assert rows(staged, "report_id", "patient_age", "source_country") == [("a", None, None), ("b", None, None)]
    assert rows(R.report_drugs(staged, strict=True), "drug_name", "drug_code", "route_code") == [("x", None, None)]
    assert rows(R.report_reactions(staged, strict=True), "reaction_term", "outcome_code") == [("r", None)]
    assert R.pairs_of_reports(staged).count() == 1


def test_strict_children(spark):
    staged = R.stage_reports(raw(spark, [doc("a", [{"medicinalproduct": "x", "drugcharacterization": "main"}])]))
    assert R.report_drugs(staged).first().drug_characterization is None
    with pytest.raises(Exception, match="does not fit"):
        R.report_drugs(staged, strict=True).collect()


def test_preview(spark):
    docs = [doc(f"r{i}", ["x"], ["q"]) for i in range(9)]
    got = [tuple(r) for r in R.extraction_preview(raw(spark, docs)).collect()]
    assert got == [(f"r{i}", "20240105", "x", "q") for i in range(5)]


def test_report_columns(spark):
    assert R.reports(R.stage_reports(raw(spark, [doc("a")]))).columns == REPORT_COLUMNS
    assert json.loads(json.dumps(doc("a")))["safetyreport"][0]["id"] == "a"

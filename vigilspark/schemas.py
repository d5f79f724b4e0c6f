"""Fixed table layouts and document paths.

Fixed values: the names below are those of the safety-report JSON format and of
the result tables a user queries, in their documented order.
"""

from __future__ import annotations

# One raw row per JSON document.
RAW_COLUMNS = ["file_id", "file_name", "ingestion_timestamp", "raw_json", "file_status"]
FILE_STATUSES = ["PENDING", "PROCESSED"]

# Report identity: first path that is present wins.
REPORT_PATH = "$.safetyreport[0]"
REPORT_ID_PATHS = ["$.safetyreport[0].safetyreportid", "$.safetyreport[0].id"]
DRUG_ARRAY_PATH = "$.safetyreport[0].patient[0].drug"
REACTION_ARRAY_PATH = "$.safetyreport[0].patient[0].reaction"
RECEIVED_DATE_PATH = "$.safetyreport[0].receivedate"

# Shape of one element of the drug and reaction arrays, kept as text until a
# child table casts it.
CODED = "array<struct<value:string,codingSystem:string>>"
DRUG_ELEMENT = (
    "struct<drgname:string,medicinalproduct:string,medicinalproductname:string,"
    f"drgcode:{CODED},activesubstancename:string,drugcharacterization:string,"
    "drugdosageform:string,drugdosage:string,"
    "drugadministrationroute:array<struct<routecode:string>>,"
    f"drugauthorizationnumber:string,drugindication:{CODED},"
    "drugcumulativedose:array<struct<value:string,doseunit:string>>,"
    "timeintervalunitofmeasure:string>"
)
REACTION_ELEMENT = (
    "struct<reactionmeddraversionpt:string,primarysourcereaction:string,"
    f"reactionmeddrapt:string,reactionmeddrallt:string,reactionoutcome:{CODED}>"
)

# Shape of one report; text is cast to types afterwards.  ``receivedate`` is text
# in most reports and an object in some.
REPORT_ELEMENT = (
    "struct<safetyreportid:string,id:string,receivedate:variant,safetyreportversion:string,"
    "transmissiondate:string,primarysource:array<struct<reportercountry:string>>,"
    "patient:array<struct<"
    "age:array<struct<value:string,agedays:string,ageyears:string>>,sex:string,"
    "onsetdate:array<string>,weight:array<struct<weight:string>>,"
    "height:array<struct<height:string>>,"
    f"drug:array<{DRUG_ELEMENT}>,reaction:array<{REACTION_ELEMENT}>>>>"
)

# Accepted date formats, first match wins.
REPORT_DATES = {
    "received_date": ["yyyyMMdd", "yyyy-MM-dd"],
    "reception_date": ["yyyyMMdd"],
    "transmission_date": ["yyyyMMdd"],
}

# Typed report values: column -> (type it must fit, type it is shown as).
REPORT_VALUES = {
    "safety_report_version": ("decimal(3,0)", "int"),
    "patient_age": ("decimal(5,2)", "decimal(5,2)"),
    "patient_age_days": ("decimal(6,0)", "int"),
    "patient_age_years": ("decimal(4,0)", "int"),
    "patient_sex": ("decimal(1,0)", "int"),
    "reaction_onset_date": ("date", "date"),
    "patient_weight_kg": ("decimal(6,2)", "decimal(6,2)"),
    "patient_height_cm": ("decimal(5,1)", "decimal(5,1)"),
}

REPORT_COLUMNS = [
    "report_id", "received_date", "reception_date", "safety_report_version",
    "transmission_date", "patient_age", "patient_age_days", "patient_age_years",
    "patient_sex", "reaction_onset_date", "patient_weight_kg", "patient_height_cm",
    "source_country", "src_ld_ts", "src_ld_date", "source_file",
]
REPORT_DRUG_COLUMNS = [
    "report_drug_id", "report_id", "received_date", "patient_sex", "patient_age",
    "drug_name", "drug_code", "drug_coding_system", "active_substance_name",
    "medicinal_product_name", "drug_characterization", "drug_dosage_form",
    "drug_dosage_text", "route_code", "authorization_number", "drug_indication",
    "indication_coding_system", "cumulative_dose_value", "cumulative_dose_unit",
    "dose_time_unit", "drug_sequence", "src_ld_ts", "src_ld_date",
]
REPORT_REACTION_COLUMNS = [
    "report_reaction_id", "report_id", "received_date", "reaction_meddra_version",
    "reaction_primary_source", "reaction_term", "reaction_term_allt",
    "outcome_coding_system", "outcome_code", "reaction_sequence", "src_ld_ts",
    "src_ld_date",
]
PAIR_COLUMNS = [
    "drug_reaction_pair_id", "report_id", "drug_name", "drug_characterization",
    "drug_sequence", "report_drug_id", "reaction_term", "reaction_sequence",
    "report_reaction_id", "src_ld_ts",
]
SIGNAL_COLUMNS = [
    "drug_name", "reaction_term", "report_count", "b_count", "c_count", "d_count",
    "ror", "prr", "ror_simple", "signal_strength", "is_significant_signal",
    "signal_generated_at",
]
SEARCH_COLUMNS = [
    "drug_name", "reaction_term", "report_count", "prr", "ror", "signal_strength",
    "is_significant_signal",
]

# Bands and thresholds.
MIN_PAIR_REPORTS = 50
HIGH_PRR, ELEVATED_PRR = 2.0, 1.0
HIGH_REPORTS, MEDIUM_REPORTS = 50, 20
RISK_LEVELS = ["HIGH", "MEDIUM", "LOW"]
SIGNAL_STRENGTHS = ["HIGH", "ELEVATED", "BASELINE"]

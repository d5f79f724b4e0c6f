"""Staged reports and their child tables.

A document is parsed once.  The staged row keeps, next to the typed report
columns, the drug and reaction arrays as typed nested columns and two flat
arrays that the statistics need:

``drug_names``      names of the drugs that have a name or a substance (NULL if
                    only a substance), with repeats, in document order
``reaction_terms``  terms of the reactions that have one, with repeats
``pair_volume``     drugs times reactions: the pair rows the report will make

Children and pairs are then functions of one row: no second parse of the raw
documents, no join back to them, and the newest version of a report always
carries exactly its own children.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fit, least_ts, make_key, parse_date
from ..functions.semistructured import first_path, path
from ..operators.latest import dedupe_latest
from ..operators.within import BLOCK, array_grid, join_within
from ..schemas import (
    DRUG_ARRAY_PATH, DRUG_ELEMENT, PAIR_COLUMNS, REACTION_ARRAY_PATH, REACTION_ELEMENT,
    RECEIVED_DATE_PATH, REPORT_COLUMNS, REPORT_DATES, REPORT_DRUG_COLUMNS, REPORT_ELEMENT,
    REPORT_ID_PATHS, REPORT_PATH, REPORT_REACTION_COLUMNS, REPORT_VALUES,
)


def report_id(doc: Column | str = "raw_json") -> Column:
    return first_path(doc, *REPORT_ID_PATHS)


def drug_name(drug: Column) -> Column:
    """First present name of a drug element."""
    return F.coalesce(drug["drgname"], drug["medicinalproduct"], drug["medicinalproductname"])


def is_named(drug: Column) -> Column:
    """A drug counts when it has a name or at least a substance."""
    return drug_name(drug).isNotNull() | drug["activesubstancename"].isNotNull()


def _report(raw: DataFrame) -> DataFrame:
    """``raw`` with its first report as a typed nested column ``_report``: one pass over the document."""
    return raw.withColumn("_report", path("raw_json", REPORT_PATH, REPORT_ELEMENT))


def _texts() -> dict[str, Column]:
    """Text of every typed report column, before it is cast."""
    report = F.col("_report")
    patient = F.get(report["patient"], 0)
    age = F.get(patient["age"], 0)
    return {
        "received_date": path(report["receivedate"], "$"),
        "reception_date": path(report["receivedate"], "$.receptiondate"),
        "safety_report_version": report["safetyreportversion"],
        "transmission_date": report["transmissiondate"],
        "patient_age": age["value"],
        "patient_age_days": age["agedays"],
        "patient_age_years": age["ageyears"],
        "patient_sex": patient["sex"],
        "reaction_onset_date": F.get(patient["onsetdate"], 0),
        "patient_weight_kg": F.get(patient["weight"], 0)["weight"],
        "patient_height_cm": F.get(patient["height"], 0)["height"],
    }


def _typed(column: str, text: Column, strict: bool = False) -> Column:
    if column in REPORT_DATES:
        return parse_date(text, *REPORT_DATES[column])
    type_, shown = REPORT_VALUES[column]
    return fit(text, type_, strict).cast(shown)


def extract_report(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Typed report columns and nested arrays of every raw document, no row dropped.

    A value that does not fit its type is NULL and listed by
    :func:`cast_errors`; ``strict`` raises instead.  The tried date formats
    never raise.
    """
    return with_flat_arrays(_typed_reports(raw, strict))


def _typed_reports(raw: DataFrame, strict: bool) -> DataFrame:
    report = F.col("_report")
    patient = F.get(report["patient"], 0)
    return _report(raw).select(
        F.coalesce(report["safetyreportid"], report["id"]).alias("report_id"),
        *[_typed(c, text, strict).alias(c) for c, text in _texts().items()],
        F.get(report["primarysource"], 0)["reportercountry"].alias("source_country"),
        F.col("ingestion_timestamp").alias("src_ld_ts"),
        F.to_date("ingestion_timestamp").alias("src_ld_date"),
        F.col("file_name").alias("source_file"),
        "file_id", patient["drug"].alias("drugs"), patient["reaction"].alias("reactions"),
    )


def with_flat_arrays(typed: DataFrame) -> DataFrame:
    """Typed reports with ``drug_names``, ``reaction_terms`` and ``pair_volume``, which follow from their nested arrays."""
    terms = F.transform("reactions", lambda r: r["reactionmeddrapt"])
    flat = typed.select(
        *REPORT_COLUMNS, "file_id", "drugs", "reactions",
        F.transform(F.filter("drugs", is_named), drug_name).alias("drug_names"),
        F.array_compact(terms).alias("reaction_terms"),
    )
    volume = F.size("drug_names").cast("long") * F.size("reaction_terms")
    has_both = F.col("drug_names").isNotNull() & F.col("reaction_terms").isNotNull()
    return flat.withColumn("pair_volume", F.when(has_both, volume).otherwise(F.lit(0).cast("long")))


def cast_errors(raw: DataFrame) -> DataFrame:
    """``(file_id, file_name, column_name, position, value)`` of values that are present but do not fit.

    ``position`` is that of the drug or reaction in its array, NULL for a value of the report.
    """
    def misfit(column: str, text: Column, typed: Column, position: Column) -> Column:
        return F.when(text.isNotNull() & typed.isNull(), F.struct(
            F.lit(column).alias("column_name"), position.cast("int").alias("position"), text.alias("value")))

    found = F.array(*[misfit(c, text, _typed(c, text), F.lit(None)) for c, text in _texts().items()])
    patient = F.get(F.col("_report")["patient"], 0)

    def of(array: str, texts: dict, fields) -> Column:
        each = F.transform(patient[array], lambda x, i: F.array(*[misfit(c, text(x), fields(x)[c], i) for c, text in texts.items()]))
        return F.coalesce(F.flatten(each), F.array().cast(_MISFITS))

    drugs = of("drug", {
        "drug_characterization": lambda d: d["drugcharacterization"],
        "cumulative_dose_value": lambda d: F.get(d["drugcumulativedose"], 0)["value"]}, drug_fields)
    reactions = of("reaction", {"outcome_code": lambda r: F.get(r["reactionoutcome"], 0)["value"]}, reaction_fields)
    return _report(raw).select("file_id", "file_name", F.inline(F.array_compact(F.concat(found, drugs, reactions))))


_MISFITS = "array<struct<column_name: string, position: int, value: string>>"


def newest_reports(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Newest version of every report, with its nested arrays alone: what travels if the rows travel again.

    Ties on load time go to the higher ``file_id``.
    """
    return dedupe_latest(_typed_reports(raw, strict))


def stage_reports(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Newest version of every report, with its nested and its flat arrays."""
    return with_flat_arrays(newest_reports(raw, strict))


def reports(staged: DataFrame) -> DataFrame:
    """The report table without the nested columns."""
    return staged.select(*REPORT_COLUMNS)


def drug_fields(d: Column, strict: bool = False) -> dict[str, Column]:
    """Columns of a drug element."""
    return {
        "drug_name": drug_name(d),
        "drug_code": F.get(d["drgcode"], 0)["value"],
        "drug_coding_system": F.get(d["drgcode"], 0)["codingSystem"],
        "active_substance_name": d["activesubstancename"],
        "medicinal_product_name": d["medicinalproduct"],
        "drug_characterization": fit(d["drugcharacterization"], "decimal(1,0)", strict).cast("int"),
        "drug_dosage_form": d["drugdosageform"],
        "drug_dosage_text": d["drugdosage"],
        "route_code": F.get(d["drugadministrationroute"], 0)["routecode"],
        "authorization_number": d["drugauthorizationnumber"],
        "drug_indication": F.get(d["drugindication"], 0)["value"],
        "indication_coding_system": F.get(d["drugindication"], 0)["codingSystem"],
        "cumulative_dose_value": fit(
            F.get(d["drugcumulativedose"], 0)["value"], "decimal(15,2)", strict),
        "cumulative_dose_unit": F.get(d["drugcumulativedose"], 0)["doseunit"],
        "dose_time_unit": d["timeintervalunitofmeasure"],
    }


def reaction_fields(r: Column, strict: bool = False) -> dict[str, Column]:
    """Columns of a reaction element."""
    return {
        "reaction_meddra_version": r["reactionmeddraversionpt"],
        "reaction_primary_source": r["primarysourcereaction"],
        "reaction_term": r["reactionmeddrapt"],
        "reaction_term_allt": r["reactionmeddrallt"],
        "outcome_coding_system": F.get(r["reactionoutcome"], 0)["codingSystem"],
        "outcome_code": fit(
            F.get(r["reactionoutcome"], 0)["value"], "decimal(2,0)", strict).cast("int"),
    }


def extract_drug(exploded: DataFrame, element: str = "element", strict: bool = False) -> DataFrame:
    """Drug columns of rows that hold one drug element (see ``functions.semistructured.flatten``)."""
    typed = path(element, "$", DRUG_ELEMENT)
    return exploded.withColumn("_drug", typed).withColumns(
        drug_fields(F.col("_drug"), strict)).drop("_drug", element)


def extract_reaction(exploded: DataFrame, element: str = "element", strict: bool = False) -> DataFrame:
    """Reaction columns of rows that hold one reaction element."""
    typed = path(element, "$", REACTION_ELEMENT)
    return exploded.withColumn("_reaction", typed).withColumns(
        reaction_fields(F.col("_reaction"), strict)).drop("_reaction", element)


def filter_named_drugs(drugs: DataFrame) -> DataFrame:
    return drugs.filter("drug_name IS NOT NULL OR active_substance_name IS NOT NULL")


def filter_reaction_present(reactions: DataFrame) -> DataFrame:
    return reactions.filter("reaction_term IS NOT NULL")


def report_drugs(staged: DataFrame, strict: bool = False) -> DataFrame:
    """One row per report and drug position."""
    rows = staged.select(
        "report_id", "received_date", "patient_sex", "patient_age", "src_ld_ts", "src_ld_date",
        F.posexplode("drugs").alias("drug_sequence", "_drug"))
    rows = rows.withColumns(drug_fields(F.col("_drug"), strict)).select(
        "*", _drug_id(F.col("drug_sequence")))
    return filter_named_drugs(rows).select(*REPORT_DRUG_COLUMNS)


def report_reactions(staged: DataFrame, strict: bool = False) -> DataFrame:
    """One row per report and reaction position."""
    rows = staged.select(
        "report_id", "received_date", "src_ld_ts", "src_ld_date",
        F.posexplode("reactions").alias("reaction_sequence", "_reaction"))
    rows = rows.withColumns(reaction_fields(F.col("_reaction"), strict)).select(
        "*", _reaction_id(F.col("reaction_sequence")))
    return filter_reaction_present(rows).select(*REPORT_REACTION_COLUMNS)


def longest_list(staged: DataFrame) -> int:
    """Largest number of child rows that a staged report makes in one child table; two flat columns are read."""
    named, terms = F.size("drug_names"), F.size("reaction_terms")
    return staged.agg(F.coalesce(F.max(F.greatest(named, terms)), F.lit(0))).first()[0]


def drug_reaction_pairs(drugs: DataFrame, reactions: DataFrame, block: int = BLOCK, longest: int | None = None) -> DataFrame:
    """Every drug row with every reaction row of the same report, from the child tables (see ``join_within`` for ``longest``)."""
    d = drugs.select("report_id", "drug_name", "drug_characterization", "drug_sequence",
                     "report_drug_id", F.col("src_ld_ts").alias("_drug_ts"))
    r = reactions.select("report_id", "reaction_term", "reaction_sequence", "report_reaction_id",
                         F.col("src_ld_ts").alias("_reaction_ts"))
    return (
        join_within(d, r, "report_id", block, longest)
        .withColumn("drug_reaction_pair_id", _pair_id())
        .withColumn("src_ld_ts", least_ts("_drug_ts", "_reaction_ts"))
        .select(*PAIR_COLUMNS)
    )


def pair_arrays(staged: DataFrame, strict: bool = False) -> DataFrame:
    """What pairs need of a report: (report_id, src_ld_ts, pair_volume, _drugs, _reactions), the arrays narrow and filtered.

    Elements keep their position in the document.
    """
    drugs = F.transform(F.filter(_indexed("drugs"), lambda x: is_named(x["value"])), lambda x: F.struct(
        x["index"].alias("index"), drug_name(x["value"]).alias("name"),
        fit(x["value"]["drugcharacterization"], "decimal(1,0)", strict).cast("int").alias("characterization")))
    reactions = F.transform(F.filter(_indexed("reactions"), lambda x: x["value"]["reactionmeddrapt"].isNotNull()),
                            lambda x: F.struct(x["index"].alias("index"), x["value"]["reactionmeddrapt"].alias("term")))
    return staged.select("report_id", "src_ld_ts", "pair_volume", drugs.alias("_drugs"), reactions.alias("_reactions"))


def pairs_of_arrays(arrays: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pair rows of :func:`pair_arrays`, which is read twice where it is not stored: two explodes in a row, no
    shuffle but for reports with very many pairs."""
    cells = array_grid(arrays, "_drugs", "_reactions", "pair_volume", "report_id", block)
    rows = cells.select("report_id", "src_ld_ts", "_reactions", F.explode("_drugs").alias("_d"))
    rows = rows.select("report_id", "src_ld_ts", "_d", F.explode("_reactions").alias("_r"))
    return (
        rows.select(
            "report_id", "src_ld_ts", F.col("_d.name").alias("drug_name"),
            F.col("_d.characterization").alias("drug_characterization"),
            F.col("_d.index").alias("drug_sequence"), _drug_id(F.col("_d.index")),
            F.col("_r.term").alias("reaction_term"),
            F.col("_r.index").alias("reaction_sequence"), _reaction_id(F.col("_r.index")))
        .withColumn("drug_reaction_pair_id", _pair_id())
        .select(*PAIR_COLUMNS)
    )


def pairs_of_reports(staged: DataFrame, block: int = BLOCK, strict: bool = False) -> DataFrame:
    """The same pair rows straight from staged reports."""
    return pairs_of_arrays(pair_arrays(staged, strict), block)


def _indexed(array: str) -> Column:
    return F.transform(array, lambda x, i: F.struct(i.alias("index"), x.alias("value")))


def _drug_id(index: Column) -> Column:
    return make_key("report_id", F.lit("-"), index.cast("string")).alias("report_drug_id")


def _reaction_id(index: Column) -> Column:
    return make_key("report_id", F.lit("-react-"), index.cast("string")).alias("report_reaction_id")


def _pair_id() -> Column:
    return make_key("report_id", F.lit("-"), "report_drug_id", F.lit("-"), "report_reaction_id")


def join_raw_to_staged(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw documents of staged reports, joined on the report id inside the document.

    Only the newest raw version of a report joins, so each report appears once.
    """
    keyed = raw.withColumn("report_id", report_id("raw_json")).withColumnRenamed(
        "ingestion_timestamp", "_loaded")
    newest = dedupe_latest(keyed, newest=("_loaded", "file_id"))
    context = staged.select("report_id", "received_date", "patient_sex", "patient_age",
                            "src_ld_ts", "src_ld_date")
    return newest.select("report_id", "file_id", "file_name", "raw_json").join(context, "report_id")


def extraction_preview(raw: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` reports by id: id, date text, first drug, first reaction."""
    doc = "raw_json"
    return raw.select(
        report_id(doc).alias("report_id"),
        path(doc, RECEIVED_DATE_PATH).alias("received_date_str"),
        path(doc, f"{DRUG_ARRAY_PATH}[0].medicinalproduct").alias("drug"),
        path(doc, f"{REACTION_ARRAY_PATH}[0].reactionmeddrapt").alias("reaction"),
    ).orderBy("report_id", "received_date_str", "drug", "reaction").limit(n)

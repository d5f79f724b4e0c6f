"""Signals: the seeded fixture, invariants and the ways to reach the same tally."""

import math
import random

import pytest
from pyspark.sql import functions as F

from samples import doc, raw, rows, seeded_docs
from vigilspark.operators.tally import tally_children, tally_pairs, tally_reports
from vigilspark.plans import consumers as C
from vigilspark.plans import marts as M
from vigilspark.plans import reports as R
from vigilspark.plans import signals as P

TALLY = ("drug_name", "reaction_term", "report_count", "drug_share", "reaction_share")


@pytest.fixture(scope="module")
def staged(spark):
    return R.stage_reports(raw(spark, seeded_docs())).cache()


def test_seeded_signals(staged):
    got = [tuple(r) for r in P.risk_signals_of_reports(staged, as_of="2024-03-01").drop("signal_generated_at").collect()]
    assert got == [
        ("DrugB", "Nausea", 100, 5, 20, 360, 360.0, (100 / 105) / (20 / 380), pytest.approx(360.0), "HIGH", True),
        ("DrugA", "ReactionX", 60, 20, 5, 400, 240.0, pytest.approx(60.75), pytest.approx(240.0), "HIGH", True),
    ]


def test_seeded_summary(staged):
    expected = [("DrugB", 105, 45.0, "HIGH"), ("DrugA", 80, 45.0, "HIGH")] + [
        (d, 60, 45.0, "HIGH") for d in ("Aspirin", "Ibuprofen", "Paracetamol", "Stat-10", "Z-Pack")]
    assert [tuple(r) for r in M.drug_summary(R.report_drugs(staged)).collect()] == expected
    assert [tuple(r) for r in M.summarise_drugs(M.drug_stats_of_reports(staged)).collect()] == expected


def test_signal_numbers(staged):
    signals = P.risk_signals_of_reports(staged)
    assert tuple(C.signal_summary(signals).first()) == (2, 2, 0, 160, 2)
    assert tuple(C.signal_summary(signals.limit(0)).first()) == (0, 0, 0, 0, 0)


def random_docs(n: int, seed: int = 5) -> list[dict]:
    pick = random.Random(seed)
    nameless = {"activesubstancename": "salt"}
    docs = []
    for i in range(n):
        drugs = [pick.choice([f"d{j}" for j in range(6)] + [nameless]) for _ in range(pick.randint(0, 5))]
        terms = [f"r{pick.randint(0, 5)}" for _ in range(pick.randint(0, 4))]
        docs.append(doc(f"R{i}", drugs, terms, patient={"age": [{"value": pick.randint(1, 90)}]}))
    # one report that dwarfs the others
    docs.append(doc("hot", [f"h{i % 40}" for i in range(200)] + ["d1", nameless],
                    [f"r{i % 30}" for i in range(150)]))
    return docs


def brute_force(docs):
    """Counts straight from the definition."""
    pairs, drugs, terms = {}, {}, {}
    for d in docs:
        r = d["safetyreport"][0]
        ds = {x.get("medicinalproduct") for x in r["patient"][0]["drug"]}
        rs = {x["reactionmeddrapt"] for x in r["patient"][0]["reaction"]}
        for a in ds if rs else ():
            drugs.setdefault(a, set()).add(r["id"])
        for b in rs if ds else ():
            terms.setdefault(b, set()).add(r["id"])
        for a in ds:
            for b in rs:
                pairs.setdefault((a, b), set()).add(r["id"])
    return ({k: len(v) for k, v in pairs.items()}, {k: len(v) for k, v in drugs.items()},
            {k: len(v) for k, v in terms.items()})


@pytest.fixture(scope="module")
def mixed(spark):
    docs = random_docs(120)
    return docs, R.stage_reports(raw(spark, docs)).cache()


@pytest.mark.parametrize("way", ["reports", "cut", "children", "split", "pairs"])
def test_tallies_match_brute_force(mixed, way):
    docs, staged = mixed
    drugs, reactions = R.report_drugs(staged), R.report_reactions(staged)
    tally = {
        "reports": lambda: tally_reports(staged),
        "cut": lambda: tally_reports(staged, block=7),
        "children": lambda: tally_children(drugs, reactions),
        "split": lambda: tally_children(drugs, reactions, block=7),
        "pairs": lambda: tally_pairs(R.pairs_of_reports(staged)),
    }[way]().cache()
    pairs, by_drug, by_term = brute_force(docs)
    assert {(r[0], r[1]): r[2] for r in tally.collect()} == pairs
    assert dict(map(tuple, P.drug_counts(tally).collect())) == by_drug
    assert dict(map(tuple, P.reaction_counts(tally).collect())) == by_term


def test_cells_add_up(mixed):
    docs, staged = mixed
    tally = tally_reports(staged).cache()
    cells = P.with_metrics(P.contingency_cells(tally, staged)).collect()
    assert cells
    for r in cells:
        assert r.report_count + r.b_count + r.c_count + r.d_count == len(docs)
        assert min(r.report_count, r.b_count, r.c_count, r.d_count) >= 0
        assert (r.ror is None) == (r.ror_simple is None)
        assert r.ror is None or math.isclose(r.ror, r.ror_simple, rel_tol=1e-12)


def test_row_order_and_partitions_do_not_matter(spark, mixed):
    docs, staged = mixed
    shuffled = docs[:]
    random.Random(1).shuffle(shuffled)
    other = R.stage_reports(raw(spark, shuffled).repartition(7))
    assert rows(tally_reports(staged), *TALLY[:3]) == rows(tally_reports(other), *TALLY[:3])
    stats = [rows(M.drug_stats_of_reports(x)) for x in (staged, other)]
    assert stats[0] == stats[1] == rows(M.drug_stats(R.report_drugs(staged)))


def test_pair_rows_by_join_and_by_explode(mixed):
    _, staged = mixed
    exploded = rows(R.pairs_of_reports(staged))
    drugs, reactions = R.report_drugs(staged), R.report_reactions(staged)
    assert rows(R.pairs_of_reports(staged, block=9)) == exploded
    assert rows(R.drug_reaction_pairs(drugs, reactions)) == exploded
    assert rows(R.drug_reaction_pairs(drugs, reactions, block=11)) == exploded


def test_nameless_drugs_count_for_reactions_only(spark):
    docs = [doc(f"A{i}", ["x"], ["r"]) for i in range(3)] + [
        doc(f"B{i}", [{"activesubstancename": "s"}], ["r"]) for i in range(2)] + [doc("C", ["y"], ["q"])]
    staged = R.stage_reports(raw(spark, docs))
    cells = P.contingency_cells(tally_reports(staged).cache(), staged)
    # reaction r: 5 reports, of which 3 with x; N = 6
    assert rows(cells.filter("drug_name = 'x'")) == [("x", "r", 3, 0, 2, 1)]
    assert (None, "r", 2) in rows(tally_reports(staged), *TALLY[:3])


def test_exclusive_pair_is_baseline(spark):
    docs = [doc(f"A{i}", ["x"], ["only"]) for i in range(50)] + [doc("B", ["y"], ["q"])]
    staged = R.stage_reports(raw(spark, docs))
    (row,) = P.risk_signals_of_reports(staged).collect()
    assert (row.c_count, row.prr, row.ror, row.signal_strength, row.is_significant_signal) == (
        0, None, None, "BASELINE", False)
    assert C.signals_topk(P.risk_signals_of_reports(staged)).first().prr is None


@pytest.mark.parametrize("n, rows_out", [(49, 0), (50, 1)])
def test_pair_threshold(spark, n, rows_out):
    docs = [doc(f"A{i}", ["x"], ["r"]) for i in range(n)] + [doc("B", ["y"], ["r"])]
    assert P.risk_signals_of_reports(R.stage_reports(raw(spark, docs))).count() == rows_out


def test_bands(spark):
    from vigilspark.functions import scalars as S
    df = spark.createDataFrame([(1.0,), (1.0000001,), (2.0,), (2.0000001,), (None,)], "prr double")
    bands = df.select(S.signal_band(F.col("prr")), S.significant(F.col("prr"), F.lit(50)),
                      S.significant(F.col("prr"), F.lit(49))).collect()
    assert [tuple(r) for r in bands] == [
        ("BASELINE", False, False), ("ELEVATED", False, False), ("ELEVATED", False, False),
        ("HIGH", True, False), ("BASELINE", False, False)]
    totals = spark.createDataFrame([(19,), (20,), (49,), (50,)], "n long")
    assert [r[0] for r in totals.select(S.risk_band(F.col("n"))).collect()] == [
        "LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_search_arguments(staged):
    signals = P.risk_signals_of_reports(staged).cache()
    assert rows(C.search_signals(signals, "ruga"), "drug_name") == [("DrugA",)]
    assert rows(C.search_signals(signals, "d%a"), "drug_name") == [("DrugA",)]
    assert C.search_signals(signals, "\\").count() == 0
    assert C.search_signals(signals, "", "", 0).count() == 2
    assert C.search_signals(signals, signal_strength="high", min_reports=61).count() == 1
    for bad in ({"limit": 0}, {"limit": 1001}, {"min_reports": -1}):
        with pytest.raises(ValueError):
            C.search_signals(signals, **bad)


def test_top_pairs_in_band_filters_after_the_first_cut(spark):
    pairs = spark.createDataFrame([(f"d{i}", "r", 100 - i) for i in range(60)],
                                  "drug_name string, reaction_term string, report_count long")
    summary = spark.createDataFrame([(f"d{i}", 10, 1.0, "LOW" if i >= 45 else "HIGH") for i in range(60)],
                                    "drug_name string, total_reports long, avg_age double, risk_level string")
    low = C.top_pairs_in_band(pairs, summary, "LOW")
    assert [r.drug_name for r in low.collect()] == [f"d{i}" for i in range(45, 50)]
    assert C.top_pairs_in_band(pairs, summary).count() == 15


def test_kpis_of_nothing(spark):
    empty = spark.createDataFrame([], "drug_name string, total_reports long, avg_age double, risk_level string")
    assert tuple(C.dashboard_kpis(empty, "HIGH").first()) == (0, 0, 0.0, 0)

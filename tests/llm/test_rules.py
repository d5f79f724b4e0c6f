import random

import cases
from vigilspark.llm import rule_ledger


def brute(text):
    text = text or ""
    w = cases.spaced_words(text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    again = {g for g in grams if grams.count(g) > 1}
    covered = {p for i, g in enumerate(grams) if g in again for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if cases.spaced_words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measurements(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(["a ", "bb ", "c ", "\n", "#d ", "É|"]) for _ in range(rng.randrange(200)))) for i in range(60)]
    rows += [r for r in cases.ROWS if r[0] != 7] + [(7, "word " * 300)]
    got = rule_ledger.judged(cases.odd(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failures").collect()
    want = sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert sorted((tuple(r)[:6] for r in got), key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.failures == 0)


def test_policies_and_ablation(spark):
    docs = cases.odd(spark)
    lines = rule_ledger.ledger(docs)
    rows = [r.failures for r in lines.collect()]
    got = {(r.policy, r.rule): (r.n_failed, r.n_sole) for r in rule_ledger.ablation(lines).collect()}
    for policy, names in rule_ledger.POLICIES.items():
        mask = rule_ledger.mask(names)
        for name in names:
            bit = rule_ledger.mask([name])
            assert got[policy, name] == (sum(bool(f & bit) for f in rows), sum(f & mask == bit for f in rows))
        assert rule_ledger.judged(docs, policy).where("kept").count() == sum(f & mask == 0 and f & rule_ledger.mask(rule_ledger.BASE) == 0 for f in rows)
    assert rule_ledger.judged(cases.empty(spark)).count() == 0

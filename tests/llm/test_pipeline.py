"""The pipeline against its stages worked out one by one."""

import corpus_pipeline
import cases
from test_pii import plain
from test_simhash import fingerprint, roots
from test_winnowing import brute
from vigilspark.llm import quality_ftrl, simhash_trie

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = {r.doc_id for r in quality_ftrl.score(docs, quality_ftrl.train(docs, labels)).where("score >= 0.3").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    prints = {i: fingerprint(t) for i, t in texts.items()}
    first = {min(i for i, f in prints.items() if f in g) for g in roots(prints.values(), simhash_trie.BITS)}
    clean = {r[0] for r in brute([(i, texts[i]) for i in first], bench) if not r[-1]}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == clean and len(out) == len(clean)
    for r in out:
        assert r.lossless and len(r.piece_ids) == r.n_pieces and not plain(r.text)
        if not plain(texts[r.doc_id]) and "<" not in r.text:
            assert r.text == texts[r.doc_id]


def test_odd_rows_pass_every_stage(spark, tmp_path):
    cases.bench(spark, [(1, "quite another text of many words that nobody has ever written in any of these documents")]).write.parquet(f"{tmp_path}/benchmark.parquet")
    cases.labels(spark, [(1, 1, 0), (2, 1, 0), (11, 1, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (cases.odd(spark), cases.empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), "test")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns
                others = docs.drop("doc_id", "text", "n_chars").distinct().collect()      # no column came back with other values
                assert [tuple(r) for r in others] in ([], [("en", "src", 1.5, 7, "s", 8, 1, 2, 3, "l", 4, 5, "f", 6, 9, 10, 11, 1, "t")])
        docs.count()


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "pieces"]

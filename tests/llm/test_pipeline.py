"""The pipeline's stages on small tables against plain Python."""

import re

import corpus_pipeline
from finquarry.llm.secret_ledger import find_secrets
from finquarry.llm.toxicity import REJECT, probabilities, train
from tests.llm.helpers import awkward, nothing, roots, shingle_set

DATA = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    p = docs.withColumn("p", probabilities(docs, train(docs, labels)))
    rows = [r for r in p.collect() if r.p.toxic < REJECT]
    seen = {name: f for name, f in corpus_pipeline.STAGES}
    one = seen["toxicity"](spark, docs, DATA)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {r.doc_id for r in rows}

    best = {}
    for r in rows:
        k = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best[k] = min(best.get(k, r), r, key=lambda r: (-len(r.text), r.doc_id))
    two = seen["exact dedup"](spark, one, DATA)
    rows = list(best.values())
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == sorted(r.doc_id for r in rows)

    sets = {r.doc_id: shingle_set(r.text, 5) for r in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = roots(sets, links)
    rows = [r for r in rows if root[r.doc_id] == r.doc_id]
    three = seen["MinHash near-dedup"](spark, two, DATA)
    assert three.columns == docs.columns and sorted(r.doc_id for r in three.collect()) == sorted(r.doc_id for r in rows)

    four = seen["secret scans"](spark, three, DATA)
    got = {r.doc_id: r for r in four.collect()}
    assert four.columns == docs.columns and set(got) == {r.doc_id for r in rows}
    for r in rows:
        assert (got[r.doc_id].text == r.text) == (not find_secrets(r.text)) and got[r.doc_id].n_chars == len(got[r.doc_id].text)

    five = seen["packing"](spark, four, DATA)
    assert {r.doc_id for r in five.select("doc_id").collect()} == {r.doc_id for r in rows}
    assert corpus_pipeline.run(spark, DATA).count() == five.count()


def test_awkward_rows_pass_every_stage(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert {r.doc_id for r in docs.collect()} >= {7, 8, 9, 10, 11}
    assert sum(r.doc_id is None for r in docs.collect()) >= 1


def test_empty_tables_pass_every_stage(spark):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing(spark), DATA)
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == nothing(spark).columns, name

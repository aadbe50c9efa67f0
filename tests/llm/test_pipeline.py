import corpus_pipeline
from playstream.llm.common import save
from playstream.llm.quality import classify
from tests.llm import test_decontaminate, test_lines, test_packing, test_simhash
from tests.llm.util import EDGE, SF0001, docs_of


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    out = save(stages["quality_classifier"](spark, docs, SF0001))
    keep = {r.doc_id for r in classify(docs, spark.read.parquet(f"{SF0001}/labels.parquet")).where("predicted = 1").collect()}
    assert sorted(r[0] for r in rows(out)) == sorted(keep) and out.columns == columns and len(keep) < docs.count()
    docs, out = out, save(stages["line_dedup"](spark, out, SF0001))
    assert sorted(rows(out), key=str) == test_lines.plain(rows(docs)) and out.columns == columns
    docs, out = out, save(stages["simhash_near_dedup"](spark, out, SF0001))
    parts = test_simhash.plain_components([(d, test_simhash.plain_fingerprint(t)) for d, t in rows(docs)])
    texts = dict(rows(docs))
    assert sorted(rows(out)) == sorted((c, texts[c]) for c in {c for _, _, c in parts}) and out.columns == columns
    docs, out = out, save(stages["benchmark_decontamination"](spark, out, SF0001))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    clean = {r[0] for r in test_decontaminate.plain(rows(docs), items) if not r[-1]}
    assert sorted(rows(out)) == sorted(r for r in rows(docs) if r[0] in clean) and out.columns == columns
    final = stages["best_fit_packing"](spark, out, SF0001).collect()
    assert sorted(tuple(r)[:5] for r in final) == sorted(test_packing.plain_pieces(rows(out)))
    test_packing.check_layout(final)


def test_edge_rows(spark):
    for given in (EDGE, []):
        docs = docs_of(spark, given)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = save(stage(spark, docs, SF0001))
            assert docs.columns == docs_of(spark, []).columns, name
        left = rows(docs)
        assert len(left) <= len(given) and len({d for d, _ in left}) == len(left)
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).collect()
        assert {r.doc_id for r in pieces} == {d for d, _ in left}


def test_registered(spark):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in __spark_entry__.oracle_sql()

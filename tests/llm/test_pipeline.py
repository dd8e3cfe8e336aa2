import corpus_pipeline
from cabflow.llm import queries as q
from tests.llm.helpers import SF, awkward, library, nothing, pairs
from tests.llm.test_near import brute_classes
from tests.llm.test_text_operators import decon_brute
from tests.llm.test_tokens_and_files import check_packing


def test_each_stage_against_brute_force(spark, tmp_out):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema, left = docs.schema, sorted(pairs(docs))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in q.op7_toxicity(spark, SF).collect() if r.predicted}

    def exact(rows):
        last = {t: i for i, t in rows}  # ascending ids
        return [(i, t) for i, t in rows if last[t] == i]

    def near(rows):
        first = {}
        for (i, _), c in zip(rows, brute_classes([t for _, t in rows]), strict=True):
            first.setdefault(c, i)
        return [(i, t) for i, t in rows if i in first.values()]

    hit = lambda row: next(decon_brute([row], items, 10))[2]
    want = [
        lambda rows: [r for r in rows if r[0] not in toxic],
        exact,
        near,
        lambda rows: [r for r in rows if not hit(r)],
    ]
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        stage(spark, docs, SF).write.parquet(f"{tmp_out}/{name}")
        docs = spark.read.parquet(f"{tmp_out}/{name}")
        assert docs.columns == schema.names
        left = expected(left)
        assert sorted(pairs(docs)) == left, name
    whole = library("word_bpe_49k.json")
    one = corpus_pipeline.packed(spark, docs, SF).collect()
    check_packing(one, left, whole)
    check_packing(corpus_pipeline.run(spark, SF).collect(), left, whole)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
        assert corpus_pipeline.packed(spark, docs, SF).count() >= docs.count()

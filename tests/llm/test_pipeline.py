import pytest

from cohortlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_registry():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10
    assert set(ORACLE) <= set(QUERIES)


def test_stages_match_what_they_drop(spark):
    import corpus_pipeline
    from cohortlens.llm.decontaminate import fold
    from cohortlens.llm.shared import stash, table

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram jaccard join", "benchmark decontamination", "sentencepiece"]
    docs = table(spark, SF, "documents")
    columns, rows = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stash(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        rows.append(docs.count())
    assert rows == sorted(rows, reverse=True) and rows[-1] > 0.5 * rows[0]
    left = docs.collect()
    folded = [fold((r.text or "").encode()) for r in left]
    assert len(set(folded)) == len(folded)
    items = [fold(r.text.encode()) for r in table(spark, SF, "benchmark").collect()]
    assert not any(i in t for i in items for t in folded)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in left) and all(r.round_trip for r in last)


@pytest.mark.parametrize("gone", ["toxicity", "near"])
def test_copies_and_toxic_documents_go(spark, make_docs, gone):
    import corpus_pipeline
    from cohortlens.llm.shared import table
    if gone == "near":
        words = [f"w{i}" for i in range(200)]
        near = words[:50] + ["new"] + words[51:]
        docs = make_docs([(1, " ".join(words)), (2, " ".join(near)), (3, "something else entirely is written here"), (None, "x")])
        left = corpus_pipeline.near_dedup(spark, docs, SF)
        assert sorted((r.doc_id for r in left.collect()), key=repr) == [1, 3, None]
    else:
        labels = table(spark, "/root/testdata/sf0.1", "labels").where("toxic = 1")
        docs = table(spark, "/root/testdata/sf0.1", "documents")
        left = corpus_pipeline.toxicity(spark, docs, "/root/testdata/sf0.1")
        toxic = docs.join(labels, "doc_id").count()
        assert left.join(labels, "doc_id").count() < 0.15 * toxic
        clean = table(spark, "/root/testdata/sf0.1", "labels").where("toxic = 0").select("doc_id")
        assert left.join(clean, "doc_id", "left_semi").count() > 0.985 * clean.count()

"""The pipeline's stages on a small corpus: decisions take effect, columns stay."""

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    from ledgerlake.llm import decontaminate, ngram_join, pii, quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "near_copies", "benchmark", "personal_data", "tokens"]
    seen = [docs]
    for name, stage in P.STAGES:
        out = stage(spark, seen[-1], SF).cache()
        if name != "tokens":
            assert out.columns == COLUMNS
        seen.append(out)
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[3] == ids[4] == ids[5]

    scores = {r.doc_id: r.predicted for r in quality.digest(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert ids[1] == {i for i, p in scores.items() if p}
    classes = ngram_join.jaccard_classes(seen[1]).collect()
    assert ids[2] == {r.component_id for r in classes}
    leaks = {r.doc_id for r in decontaminate.contaminated(
        seen[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids[3] == ids[2] - leaks
    plain = {r.doc_id: r.text for r in seen[3].collect()}
    for r in seen[4].collect():
        assert r.text == pii.mask_text(plain[r.doc_id], pii.find_spans(plain[r.doc_id])) and r.n_chars == len(r.text)
        assert not [s for s in pii.find_spans(r.text) if s[0] == "email"]
    for r in seen[5].collect():
        assert r.round_trip and r.n_tokens == len(r.ids)


def test_run_equals_the_stages_and_an_empty_corpus_passes(spark):
    out = P.run(spark, SF)
    assert out.columns == [*COLUMNS, "ids", "n_tokens", "round_trip"] and out.count() > 50
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0

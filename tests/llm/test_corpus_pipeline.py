import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wardlake.llm import near_dedup, secret_scan, substring, toxicity
from wardlake.llm.queries import QUERIES, WORD_BPE, table

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_the_columns_and_run_gives_the_last(spark, corpus):
    docs, sizes = corpus, [corpus.count()]
    columns = corpus.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.Scratch(spark, "test").keep(stage(spark, docs, SF), name)
        assert docs.dtypes == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] == sizes[4]
    encode = Tokenizer.from_file(WORD_BPE).encode
    expected = {r.doc_id: encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    found = {}
    for p in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda p: p.start):
        found.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert found == expected


def test_stages_decide_as_their_operators_do(spark, corpus):
    labels = table(spark, SF, "labels")
    toxic = {r.doc_id for r in toxicity.score(corpus, labels).collect() if r.predicted}
    first = corpus_pipeline.drop_toxic(spark, corpus, SF)
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in corpus.collect()} - toxic
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum(known.get(i, 1) for i in toxic) >= 0.9 * len(toxic)
    kept = {r.doc_id for r in near_dedup.near_duplicates(corpus).collect() if r.kept}
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, corpus, SF).collect()} == kept
    clean = corpus_pipeline.remove_repeats(spark, corpus, SF)
    assert all(r.n_chars == len(r.text) for r in clean.collect())
    again, names = substring.remove_repeats(corpus)
    assert {(r.doc_id, r.text) for r in again.collect()} == {(r.doc_id, r.text) for r in clean.collect()}
    assert secret_scan.scan(corpus_pipeline.redact_secrets(spark, corpus, SF)).filter("base_spans != ''").count() == 0


def test_odd_rows_pass(spark, odd, nothing):
    documents, _ = odd
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == documents.columns
    assert {r.doc_id for r in docs.collect()} == {1, 2, 5, 6, None}


@pytest.mark.parametrize("n", range(1, 11))
def test_each_operator_has_one_query(n):
    assert len([q for q in QUERIES if q.startswith(f"op{n}_")]) == 1

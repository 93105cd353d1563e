"""Each stage of the pipeline against a plain version, on what the stage before it kept."""

import numpy as np
import pytest
from test_packing import check as check_packing
from test_simhash import plain_components, plain_fingerprint
from test_suffix_dedup import plain_words

import corpus_pipeline
from salesprep.llm import decontamination, quality_classifier
from salesprep.llm.queries import GOOD, quality_model
from salesprep.llm.shared import stage
from salesprep.sources import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents, and what each stage made of what came before."""
    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        tables.append(stage(step(spark, tables[-1], SF), name))
    return tables


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    assert [x.columns for x in stages[:-1]] == [stages[0].columns] * 5
    assert stages[5].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_classifier_rejects(spark, stages):
    model = quality_model(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    tools = quality_classifier.Compressors(model.bad, model.good)
    want = {}
    for doc, text in texts(stages[0]).items():
        z = quality_classifier.design(np.array([tools.features((text or "").encode())])) @ np.array(model.weights)
        if quality_classifier.logistic(z)[0] >= GOOD:
            want[doc] = text
    assert texts(stages[1]) == want and 0 < len(want) < stages[0].count()


def test_one_of_each_near_duplicate_group(stages):
    docs = texts(stages[1])
    roots = plain_components([(d, plain_fingerprint(t, 3)) for d, t in docs.items()])
    want = {d: docs[d] for d in set(roots)}
    assert texts(stages[2]) == want and len(want) < len(docs)


def test_repeated_passages_go(stages):
    docs = texts(stages[2])
    want = dict(zip(docs, plain_words(list(docs.values())), strict=True))
    assert texts(stages[3]) == want and want != docs
    assert stages[3].where("n_chars <> length(text)").count() == 0


def test_benchmark_passages_go(spark, stages):
    bench = [decontamination.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    known = {}
    for words in bench:
        for w in words:
            known.setdefault(w, len(known))
    items = [decontamination.numbered(w, known) for w in bench]
    want = {}
    for doc, text in texts(stages[3]).items():
        ids = decontamination.numbered(decontamination.words_of(text), known)
        if max(decontamination.align(i, ids)[0] / (2 * len(i)) for i in items) < decontamination.LEAST_SCORE:
            want[doc] = text
    assert texts(stages[4]) == want and len(want) < stages[3].count()


def test_packed(stages):
    used, least = check_packing(stages[5], list(texts(stages[4]).items()), 2048)
    assert used <= least + 1


def test_whole_run_leaves_its_result_alone(spark):
    """Of all that is staged on the way, only the rows that come back are left."""
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/llm/{spark.sparkContext.applicationId}"
    before = set(catalog.children(spark, folder))
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert len(set(catalog.children(spark, folder)) - before) == 1
    assert rows.count() > 0


def test_awkward_documents_go_through(spark, awkward, empty):
    """Nulls, empty and long texts, repeated rows and clashing names; an empty table."""
    for docs in (awkward, empty):
        rows, names = docs, docs.columns
        for name, step in corpus_pipeline.STAGES:
            rows = stage(step(spark, rows, "/root/testdata/sf0.001"), name)
            assert rows.columns == names or name == "best_fit_packing"
    assert rows.count() == 0

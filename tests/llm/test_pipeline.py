import numpy as np
import pytest
from test_decontamination import expected
from test_minhash import plain_components
from test_suffixes import plain_spans

import corpus_pipeline
from velograph.llm import quality
from velograph.llm.common import read_table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage, and what comes out of the last."""
    folder = tmp_path_factory.mktemp("stages")
    tables = [read_table(spark, FOLDER, "documents").unionByName(
        spark.createDataFrame(
            [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "a b c d e f", "en", "s", 11)],
            "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
        )
    )]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, tables[-1], FOLDER).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return [t.toPandas().sort_values(t.columns[0]).reset_index(drop=True) for t in tables]


def test_all_but_the_last_stage_keep_the_columns(stages):
    assert len({tuple(t.columns) for t in stages[:-1]}) == 1


def test_quality_stage_keeps_what_the_classifier_keeps(spark, stages):
    docs = spark.createDataFrame(stages[0][["doc_id", "text", "lang"]])
    model = quality.train(docs, read_table(spark, FOLDER, "labels"))
    scores = model.scores([(t or "").encode() for t in stages[0]["text"]])
    assert set(stages[1]["doc_id"]) == set(stages[0]["doc_id"][scores >= 0.7])
    assert 0.5 < len(stages[1]) / len(stages[0]) < 1


def test_near_duplicate_stage_keeps_the_first_of_each_group(stages):
    components, _ = plain_components(stages[1]["text"].tolist())
    kept = [k for k, c in enumerate(components) if k == c]
    assert stages[2]["doc_id"].tolist() == stages[1]["doc_id"].iloc[kept].tolist()


def test_suffix_stage_cuts_repeats(stages):
    removed = plain_spans([t or "" for t in stages[2]["text"]], 200)
    assert stages[3]["doc_id"].tolist() == stages[2]["doc_id"].tolist()
    for text, cut, after, chars in zip(stages[2]["text"], removed, stages[3]["text"], stages[3]["n_chars"], strict=True):
        body = np.frombuffer((text or "").encode(), dtype=np.uint8)
        assert after == body[~cut].tobytes().decode("utf-8", "ignore") and chars == len(after)


def test_decontamination_stage_drops_the_contaminated(spark, stages):
    items = [(str(r["item_id"]), r["text"]) for r in read_table(spark, FOLDER, "benchmark").collect()]
    keep = []
    for doc, text in zip(stages[3]["doc_id"], stages[3]["text"], strict=True):
        n_words, n_hit, _ = expected(text, items)
        if not (n_hit and 20 * n_hit >= n_words):
            keep.append(doc)
    assert stages[4]["doc_id"].tolist() == keep


def test_packing_stage_packs_every_document(stages):
    pieces = stages[5]
    assert set(pieces["doc_id"]) == set(stages[4]["doc_id"])
    assert pieces.groupby("doc_id")["length"].sum().equals(pieces.groupby("doc_id")["doc_tokens"].first().rename("length"))
    assert pieces.groupby("sequence_id")["length"].sum().max() <= 2048


def test_run_is_all_stages(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == list(stages[5].columns)
    assert found.where("doc_id >= 0").select("doc_id").distinct().count() > 0

"""Rows whose ids repeat or are missing, in the near-duplicate stage."""

import random

import corpus_pipeline

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def text(seed, words=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(500)}" for _ in range(words))


def stay(spark, rows):
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], SCHEMA).repartition(3)
    found = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "unused")
    assert found.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr)


def test_of_repeated_rows_one_stays(spark):
    assert stay(spark, [(1, text(1)), (1, text(1)), (1, text(1)), (2, text(2))]) == [(1, text(1)), (2, text(2))]


def test_of_copies_without_id_one_stays(spark):
    assert stay(spark, [(None, text(1)), (None, text(1) + " end"), (None, text(2))]) in (
        sorted([(None, text(1)), (None, text(2))], key=repr),
        sorted([(None, text(1) + " end"), (None, text(2))], key=repr),
    )
    assert stay(spark, [(None, text(1)), (8, text(1) + " end")]) == [(8, text(1) + " end")]


def test_of_two_texts_with_one_id_only_the_copy_goes(spark):
    assert stay(spark, [(1, text(1)), (5, text(1)), (5, text(2))]) == [(1, text(1)), (5, text(2))]


def test_groups_are_found_through_either_text_of_an_id(spark):
    rows = [(3, text(1)), (3, text(2)), (4, text(1) + " end"), (6, text(2) + " end"), (7, text(3))]
    assert stay(spark, rows) == sorted([(3, text(1)), (3, text(2)), (7, text(3))], key=repr)


def test_rows_without_words_stay(spark):
    assert stay(spark, [(1, ""), (1, ""), (None, None), (None, None)]) == [(1, ""), (1, ""), (None, None), (None, None)]


def small_documents(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(40 + k)), "en", "s", 1, f"own{k}", k) for k in range(4)]
    rows.append((9, "very long " + " ".join(f"v{j}" for j in range(120_000)), "en", "s", 1, "own9", 9))
    return spark.createDataFrame(rows, f"{SCHEMA}, _mark STRING, component_id BIGINT")


def test_columns_of_any_name_stay_as_they_are(spark):
    docs = small_documents(spark)
    before = {r["doc_id"]: tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, "/root/testdata/sf0.001")
        assert found.columns == docs.columns, name
        rows = {r["doc_id"]: tuple(r) for r in found.collect()}
        assert all(rows[k][5:] == before[k][5:] and rows[k][1] == before[k][1] for k in rows), name
        assert len(rows) == 5 or name == "quality classifier"


def test_stages_without_documents(spark):
    docs = small_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0

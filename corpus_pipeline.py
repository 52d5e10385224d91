"""The corpus pipeline: from raw documents to packed sequences, each stage written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.llm import quality
from velograph.llm.common import Workspace, read_table, without_rows
from velograph.llm.decontamination import contamination_columns, find_benchmark_text
from velograph.llm.minhash import near_duplicates
from velograph.llm.packing import pack_documents
from velograph.llm.queries import tokenizer_path
from velograph.llm.suffixes import remove_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _mark(docs: DataFrame) -> str:
    """A name for a column that a stage adds meanwhile, other than those of the documents."""
    name = "_mark"
    while name in docs.columns:
        name += "_"
    return name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels, does not reject."""
    mark, model = _mark(docs), quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, result=mark)
    return scored.where(F.col(mark) >= quality.CUT).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the least id, one without an id last.

    Ids may be missing or repeat, so rows get a key of their own. Of rows with the least id that of the
    least text hash stays, of equal ones the first. A row without words is in no group and stays.
    """
    work, mark = Workspace(spark), _mark(docs)
    rows = work.keep(docs.withColumn(mark, F.monotonically_increasing_id()))
    found = near_duplicates(rows.select(mark, "text"), doc_id=mark).select(F.col("doc_id").alias(mark), "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text"), mark)
    first = found.join(rows.select(mark, place.alias("place")), mark).groupBy("component_id").agg(F.min("place").alias("place"))
    others = found.select(mark).join(first.select(F.col("place")[mark].alias(mark)), mark, "left_anti")
    return without_rows(rows, others, mark, work).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the byte strings that occur elsewhere; n_chars follows the new text."""
    mark = _mark(docs)
    found = remove_repeats(docs, result=mark)
    text = F.col(f"{mark}.kept_text")
    changed = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return found.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    mark = _mark(docs)
    found = find_benchmark_text(docs, read_table(spark, sf_dir, "benchmark"), result=mark)
    return contamination_columns(found.select(F.struct(*docs.columns).alias("row"), mark), mark).where(
        "NOT contaminated"
    ).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one_of_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

# No SQL can train the classifier; the stages are tested against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    work = Workspace(spark)
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        following = work.keep(stage(spark, docs, sf_dir))
        if before is not None:
            work.drop(before)
        docs = before = following
    return docs


QUERIES = {"pipeline": run}
ORACLE_SQLS: dict[str, str] = {}

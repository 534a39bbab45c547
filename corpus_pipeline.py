"""A corpus from raw documents to packed token rows, in five stages.

Each stage takes (spark, docs, sf_dir) and works on what the stage before kept;
all but the last return the columns of ``documents``. Rows that an operator
cannot judge follow its docstring: texts without a word fall to the quality stage,
a null id is an id of its own. Extra columns travel along under private names, so
no column of an operator takes the place of one of theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontaminate, mixing, ngram_join, quality, queries, token_packing
from starloom.runtime import cut_lineage


#: What operators read; all other columns are out of their sight.
READ = ("doc_id", "text", "lang")


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``stage(docs)`` with the columns of ``docs``, those that no operator reads untouched."""
    hidden = {c: f"_document_column_{k}" for k, c in enumerate(docs.columns) if c not in READ}
    out = stage(docs.withColumnsRenamed(hidden))
    return out.select(*[F.col(hidden.get(c, c)).alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression expects to be of grade 1 or more."""
    model = queries.quality_model(spark, sf_dir, docs.select("doc_id", "text"))
    return _apart(docs, lambda rows: quality.score(rows, model).where("keep"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8 or more."""
    return _apart(docs, ngram_join.one_of_each)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = queries.table(spark, sf_dir, "benchmark")
    return _apart(docs, lambda rows: decontaminate.without_leaks(rows, items))


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the languages reach their target shares; none is cut, so each stays at least once."""
    model = queries.language_model(spark, sf_dir, docs)
    members = cut_lineage(mixing.memberships(docs, model, keep=["doc_id"]))
    _, moves = mixing.rates(members, mixing.spread(queries.LANGUAGE_TARGETS, model.domains), keep_all=True)
    times = F.greatest(F.lit(1), mixing.copies("mix_rate", "doc_id", "text"))

    def repeated(rows: DataFrame) -> DataFrame:
        return mixing.memberships(rows, model, moves=moves).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), times)))

    return _apart(docs, repeated)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return token_packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("decontamination", drop_leaks),
    ("mixing", mix_languages),
    ("token_packing", pack_tokens),
]

#: Classifiers and packing have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed rows of ``documents``. Every stage but the last is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

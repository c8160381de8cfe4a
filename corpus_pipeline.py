"""A corpus pipeline of five stages over ``documents``; each stage's rows are written and read again by the next.

What a stage wrote on its way is dropped when a later stage starts on rows that do not read it, since its
result is written by then. So one pipeline runs at a time in a session, and a stage's result is written before the next one starts.
The driver gives free memory back as it goes, since all stages of all runs in a session pass through it.
Columns beyond those of ``documents`` are carried along under names of their own, so none clashes with an operator's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from weakref import WeakKeyDictionary

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm import jaccard_join, mixing, piece_lattice, quality_rules, suffix_dedup
from postings.llm.shipping import ship
from postings.llm.workers import let_driver_go
from postings.sources.warehouse import Intermediates, intermediates, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = {"doc_id", "text", "lang", "source", "n_chars"}
#: Per context (place of the stage, what it wrote), of stages whose intermediates are still there.
_LEFT: WeakKeyDictionary = WeakKeyDictionary()


def placed(place: int, last: bool = False) -> Callable[[Stage], Stage]:
    """A stage at its place: earlier intermediates go, and unless it is the ``last`` one its rows come back with the columns they had."""
    def wrap(stage: Stage) -> Stage:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            left: list[tuple[int, Intermediates]] = _LEFT.setdefault(spark.sparkContext, [])
            for entry in [e for e in left if e[0] < place and not e[1].read_by(docs)]:
                entry[1].drop()
                left.remove(entry)
            let_driver_go(spark)
            names = docs.columns
            with intermediates(let_driver_go) as made:
                found = stage(spark, docs.toDF(*[c if c in COLUMNS else f"carried_along_{k}" for k, c in enumerate(names)]), sf_dir)
            left.append((place, made))
            return found if last else found.toDF(*names)

        return run_stage

    return wrap


@placed(0)
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go."""
    return quality_rules.judge(docs).where("kept").select(*docs.columns)


@placed(1)
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word shingles one row with the smallest id stays, NULL last; of its rows the first by the text's hash.

    Rows are told apart by a number of their own, written once, so ids may repeat or be NULL. Texts without words are
    alike only if id and text are equal.
    """
    ship(spark)
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()))
    found = jaccard_join.join(numbered.select(F.col("_row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_linked"), (F.col("n_shingles") == 0).alias("_empty"))
    rows = numbered.select("_row", F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.col("text").isNull().alias("_null"))
    rows = rows.join(found, "_row")
    alike = [F.when(F.col("_empty"), F.col(c)) for c in ("_id", "_hash", "_null")]
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash", "_row"))
    heads = rows.groupBy("_empty", F.when(~F.col("_empty"), F.col("_linked")), *alike).agg(first["_row"].alias("_row"))
    return numbered.join(heads.select("_row"), "_row", "left_semi").select(*docs.columns)


@placed(2)
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of long strings that occur earlier are cut out of the texts; a text of which nothing is left goes."""
    ship(spark)
    return suffix_dedup.deduplicated(docs)


@placed(3)
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a row is there once for each time it is taken."""
    return mixing.mixture(docs)


@placed(4, last=True)
def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces, decoded_sha256) of every row of the mix, the last from the text decoded back."""
    ship(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    d = piece_lattice.decode(piece_lattice.encode(docs, path), path)
    return d.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", rules),
    ("jaccard_join", near_copies),
    ("suffix_dedup", repeats),
    ("mixture", mixture),
    ("piece_lattice", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; rows are written between stages to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs


#: Robust covariance, suffix order and lattices have no SQL form; tests compare with brute-force versions.
ORACLE_SQL = None

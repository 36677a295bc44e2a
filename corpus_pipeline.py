"""A training corpus out of ``documents``: stages that each read what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coinfold.llm.common import staged
from coinfold.llm.mixing import mixed
from coinfold.llm.packing import pack
from coinfold.llm.secrets import redacted
from coinfold.llm.simhash import one_of_each_group
from coinfold.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go; an empty table stays empty, and without labels of both kinds all documents stay.

    A null text is judged as an empty one. Repeated rows are judged alike. All columns pass, whatever their names.
    """
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id; an empty table stays empty.

    Near copies are those that op3 links. A null or blank text has fingerprint zero and is near others of that kind. Of rows that repeat
    an id and a text one stays; rows of one id with unlike texts are told apart. A row without an id stays. All columns pass.
    """
    return one_of_each_group(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts by their kind in brackets, and n_chars follows; every document stays.

    Overlapping secrets are replaced as one, by the kind of the first. A null or empty text stays as it is, and so do other columns of
    any name. Repeated rows are changed alike. Texts are searched whole. An empty table stays empty.
    """
    return redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice; an empty table stays empty.

    A null or blank text has no words and is not taken. A null source is one of its own, the last. Ties of keys go to the smaller id,
    then to the row read first; rows that repeat an id count each. All columns pass, whatever their names.
    """
    return mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their place in sequences of at most 2048 tokens; none for an empty table.

    A null text is packed as an empty one, a single token. Repeated rows are documents of their own; a null id stays null. Among pieces
    of one length the places follow the order of the rows read. Columns but doc_id and text are left behind.
    """
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", simhash_stage),
    ("secret scans", secrets_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Fingerprints, a trained model and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

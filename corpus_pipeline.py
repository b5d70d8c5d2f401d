"""The corpus pipeline, and the queries of the corpus operators.

Defined for every stage: NULL and empty texts are documents like others; rows without an id stay unless
their text is rejected or holds a benchmark item; repeated rows of an id stay or go together as near copies;
an empty table gives an empty one; other columns, whatever their names, are carried along (the last stage
replaces those named like its own).

Each stage takes the rows that its predecessor kept. Rows go for low quality, for being a near copy
of a document that stays, or for holding benchmark items; personal data is masked in the texts
(``n_chars`` follows); the last stage adds the ids of every text, whose decoding is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenroll.llm import bpe, decontaminate, jaccard, pii, quality
from screenroll.llm.common import read, ship, stage
from screenroll.llm.queries import BPE
from screenroll.llm.queries import REGISTRY as OPERATOR_QUERIES

#: What counts as a near copy here; the query op10_jaccard has its own, stricter rule.
NEAR_COPIES = jaccard.Rule(n=5, link=80, of=100)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship(spark)
    stats = quality.stats_table(docs)
    model = quality.train(quality.learnable(stats), read(spark, sf_dir, "labels"), "quality")
    return quality.keep_good(docs, model)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies (5-word shingles, similarity 0.8)."""
    ship(spark)
    return jaccard.keep_one(docs, rule=NEAR_COPIES)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    ship(spark)
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    # The operator's column must not replace one of the documents.
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c.lower() == "pii"}
    masked = pii.redact(pii.find_pii(docs.withColumnsRenamed(own))).drop("pii")
    masked = masked.withColumnsRenamed({new: c for c, new in own.items()})
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their packed ids, number of ids, and whether these decode to the text.

    Columns of the documents named like one of these, or ``decoded``, are replaced.
    """
    ship(spark)
    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens", "intact", "decoded")]
    decoded = bpe.round_trip(docs.select(*kept), **BPE)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select(*kept, "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), same.alias("intact"))


STAGES = [
    ("quality", keep_quality),
    ("near_copies", keep_first_copies),
    ("decontamination", keep_uncontaminated),
    ("personal_data", mask_personal_data),
    ("tokens", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the classifier, the alignment or the encoding.
ORACLE_SQL = None

REGISTRY = OPERATOR_QUERIES | {"pipeline": (run, ORACLE_SQL)}

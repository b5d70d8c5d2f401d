"""Registered queries of the corpus operators: name -> (query, DuckDB statement or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import report as bpe_report
from .codes import codes_sql
from .codes import report as code_report
from .common import read, ship
from .decontaminate import find_leaks
from .jaccard import jaccard_sql, join_components
from .langid import report as language_report
from .licenses import report as license_report
from .oracle_pii import pii_sql
from .pii import report as pii_report
from .quality import report as quality_report
from .spelling import report as spelling_report
from .spelling import spelling_sql
from .substrings import report as substring_report
from .substrings import substring_sql
from .topk import report as topk_report
from .topk import topk_sql
from .toxicity import report as toxicity_report
from .warc import report as warc_report
from .warc import warc_sql

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _over(operator: Callable[..., DataFrame], *tables: str, **options) -> Query:
    """An operator applied to whole tables."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(*[read(spark, sf_dir, t) for t in tables], **options)

    return query


BPE = {"rank_path": RANKS, "pattern": public_tokenizers.PATTERN}

REGISTRY: dict[str, tuple[Query, str | None]] = {
    "op1_pii": (_over(pii_report, "documents"), pii_sql()),
    "op2_warc": (_over(warc_report, "pages"), warc_sql()),
    "op3_licenses": (_over(license_report, "documents"), None),
    "op4_toxicity": (_over(toxicity_report, "documents", "labels"), None),
    "op5_decontamination": (_over(find_leaks, "documents", "benchmark"), None),
    "op6_bpe": (_over(bpe_report, "documents", **BPE), None),
    "op7_quality": (_over(quality_report, "documents", "labels"), None),
    "op8_topk": (_over(topk_report, "embeddings"), topk_sql()),
    "op9_substrings": (_over(substring_report, "documents"), substring_sql()),
    "op10_jaccard": (_over(join_components, "documents"), jaccard_sql()),
    "op11_language": (_over(language_report, "documents"), None),
    "op12_spelling": (_over(spelling_report, "documents"), spelling_sql()),
    "op13_codes": (_over(code_report, "embeddings"), codes_sql()),
}

"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm.ann import op4_kmeans_tree
from ledgermill.llm.centroids import OP12_SQL, op12_centroids
from ledgermill.llm.decontamination import OP5_SQL, op5_decontamination
from ledgermill.llm.filter_audit import OP13_SQL, op13_filter_audit
from ledgermill.llm.licenses import OP9_SQL, op9_license_scan
from ledgermill.llm.lines import OP8_SQL, op8_line_dedup
from ledgermill.llm.mixing import op2_pivotal_mixing
from ledgermill.llm.quality import op1_pu_quality
from ledgermill.llm.sharding import op3_kd_sharding
from ledgermill.llm.simhash import op6_simhash
from ledgermill.llm.substrings import OP7_SQL, op7_substring_dedup
from ledgermill.llm.tokens import op11_byte_bpe
from ledgermill.llm.toxicity import op10_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pu_quality,
        op2_pivotal_mixing,
        op3_kd_sharding,
        op4_kmeans_tree,
        op5_decontamination,
        op6_simhash,
        op7_substring_dedup,
        op8_line_dedup,
        op9_license_scan,
        op10_toxicity,
        op11_byte_bpe,
        op12_centroids,
        op13_filter_audit,
    )
}

ORACLES: dict[str, str] = {
    "op5_decontamination": OP5_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op8_line_dedup": OP8_SQL,
    "op9_license_scan": OP9_SQL,
    "op12_centroids": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}

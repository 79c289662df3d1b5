"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tariffbook.llm import (
    chat,
    decontaminate,
    digests,
    fill_in_middle,
    id_shards,
    importance,
    licenses,
    minhash,
    packing,
    periodic_runs,
    simhash,
    token_counts,
    url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_quality_classifier": importance.op2_quality_classifier,
    "op3_packing": packing.op3_packing,
    "op4_simhash_dedup": simhash.op4_simhash_dedup,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_chat_windows": chat.op7_chat_windows,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_id_shards": id_shards.op9_id_shards,
    "op10_document_digests": digests.op10_document_digests,
    "op11_minhash_dedup": minhash.op11_minhash_dedup,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
SQL: dict[str, str] = {
    "op1_url_filters": url_filters.OP1_SQL,
    "op11_minhash_dedup": minhash.OP11_SQL,
    "op12_fill_in_middle": fill_in_middle.OP12_SQL,
    "op13_periodic_runs": periodic_runs.OP13_SQL,
}

"""Queries of the text operators, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forelight.llm import alignment, bpe, fingerprint, licenses, lines, pfp, pii, quality, repair, sharding, superminhash, toxicity, winnow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_prefix_free_parsing": pfp.op2_prefix_free_parsing,
    "op3_label_propagation": sharding.op3_label_propagation,
    "op4_personal_data": pii.op4_personal_data,
    "op5_bpe_lexicon": bpe.op5_bpe_lexicon,
    "op6_superminhash": superminhash.op6_superminhash,
    "op7_bottom_k": fingerprint.op7_bottom_k,
    "op8_winnowing": winnow.op8_winnowing,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_fuzzy_lines": lines.op10_fuzzy_lines,
    "op11_license_scan": licenses.op11_license_scan,
    "op12_alignment": alignment.op12_alignment,
    "op13_repair": repair.op13_repair,
}
ORACLES: dict[str, str] = {
    "op2_prefix_free_parsing": pfp.OP2_SQL,
    "op6_superminhash": superminhash.OP6_SQL,
    "op8_winnowing": winnow.OP8_SQL,
    "op11_license_scan": licenses.OP11_SQL,
    "op13_repair": repair.OP13_SQL,
}

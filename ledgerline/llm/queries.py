"""The registered queries of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    fingerprint,
    html_text,
    language_id,
    license_scan,
    linededup,
    merkle,
    mix,
    neardup,
    packing,
    quality,
    secrets,
    substring,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mix": mix.op1,
    "op2_neardup": neardup.op2,
    "op3_html_text": html_text.op3,
    "op4_licenses": license_scan.op4,
    "op5_fingerprints": fingerprint.op5,
    "op6_line_dedup": linededup.op6,
    "op7_secrets": secrets.op7,
    "op8_packing": packing.op8,
    "op9_substring_dedup": substring.op9,
    "op10_host_quality": quality.op10,
    "op11_whitening": whitening.op11,
    "op12_language_id": language_id.op12,
    "op13_merkle_manifest": merkle.op13,
}

ORACLES: dict[str, str] = {
    "op1_pareto_mix": mix.ORACLE,
    "op2_neardup": neardup.ORACLE,
    "op6_line_dedup": linededup.ORACLE,
    "op9_substring_dedup": substring.ORACLE,
    "op10_host_quality": quality.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}

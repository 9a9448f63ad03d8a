"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ann, centroids, language_id, license_scan, media, mixing, packing, simhash, substring_dedup, toxicity, url_filter, vector_codes, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": url_filter.op1_url_filters,
        "op2_simhash": simhash.op2_simhash,
        "op3_ann": ann.op3_ann,
        "op4_warc": warc.op4_warc,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_packing": packing.op6_packing,
        "op7_media_columns": media.op7_media_columns,
        "op8_suffix_dedup": substring_dedup.op8_suffix_dedup,
        "op9_license_scan": license_scan.op9_license_scan,
        "op10_mixing": mixing.op10_mixing,
        "op11_centroids": centroids.op11_centroids,
        "op12_vector_codes": vector_codes.op12_vector_codes,
        "op13_language_id": language_id.op13_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": url_filter.OP1_SQL, "op4_warc": warc.OP4_SQL, "op10_mixing": mixing.OP10_SQL, "op11_centroids": centroids.OP11_SQL, "op12_vector_codes": vector_codes.OP12_SQL}

"""Queries of this subpackage, by name, and the DuckDB statements for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op9_ann
from .extraction import op4_extraction
from .filters import OP11_SQL, op11_filter_audit
from .leaks import OP12_SQL, op12_decontamination
from .lexical import OP13_SQL, op13_search
from .mixing import OP3_SQL, op3_mixing
from .licences import op5_licences
from .minhash import OP6_SQL, op6_minhash
from .ogg import op2_ogg_media
from .packing import op10_packing
from .pii import OP8_SQL, op8_pii, op8_pii_terms
from .records import op1_token_records
from .toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_ogg_media": op2_ogg_media,
    "op3_mixing": op3_mixing,
    "op4_extraction": op4_extraction,
    "op5_licences": op5_licences,
    "op6_minhash": op6_minhash,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op8_pii_terms": op8_pii_terms,
    "op9_ann": op9_ann,
    "op10_packing": op10_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_decontamination": op12_decontamination,
    "op13_search": op13_search,
}

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": OP3_SQL,
    "op6_minhash": OP6_SQL,
    "op8_pii": OP8_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_decontamination": OP12_SQL,
    "op13_search": OP13_SQL,
}

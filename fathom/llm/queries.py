"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathom.llm import decontaminate, filter_audit, hard_negatives, url_filter
from fathom.llm.decontaminate import op10_decontaminate
from fathom.llm.filter_audit import op13_filter_audit
from fathom.llm.hard_negatives import op12_hard_negatives
from fathom.llm.near_duplicates import op5_near_duplicates
from fathom.llm.neighbours import op7_neighbours
from fathom.llm.ngram_join import op11_ngram_join
from fathom.llm.packing import op1_packing
from fathom.llm.personal_data import op4_personal_data
from fathom.llm.secret_scan import op6_secret_scans
from fathom.llm.token_counts import op8_token_counts
from fathom.llm.toxicity import op3_toxicity
from fathom.llm.url_filter import op9_url_filter
from fathom.llm.warc import op2_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_personal_data": op4_personal_data,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_secret_scans": op6_secret_scans,
    "op7_neighbours": op7_neighbours,
    "op8_token_counts": op8_token_counts,
    "op9_url_filter": op9_url_filter,
    "op10_decontaminate": op10_decontaminate,
    "op11_ngram_join": op11_ngram_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op9_url_filter": url_filter.ORACLE_SQL,
    "op10_decontaminate": decontaminate.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}

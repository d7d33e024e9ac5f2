"""The operators' queries and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from . import centroids, chat, hard_negatives, urls
from .centroids import op13_centroid_clusters
from .chat import op5_chat_windows
from .decontaminate import op4_decontaminate
from .hard_negatives import op11_hard_negatives
from .licenses import op8_license_scan
from .near_duplicates import op3_near_duplicates
from .packing import op2_packing
from .quality_model import op9_quality_model
from .quality_rules import op6_quality_rules
from .repeats import op7_suffix_dedup
from .swap_packing import op12_best_fit_packing
from .token_files import op10_token_files
from .urls import op1_url_filter

QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_packing, op3_near_duplicates, op4_decontaminate, op5_chat_windows,
    op6_quality_rules, op7_suffix_dedup, op8_license_scan, op9_quality_model, op10_token_files,
    op11_hard_negatives, op12_best_fit_packing, op13_centroid_clusters)}

ORACLE = {"op1_url_filter": urls.ORACLE, "op5_chat_windows": chat.ORACLE,
          "op11_hard_negatives": hard_negatives.ORACLE,
          "op13_centroid_clusters": centroids.ORACLE}

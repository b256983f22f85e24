"""The queries of this subpackage and the SQL they are compared with."""

from __future__ import annotations

from .audio import op10_audio_features
from .html import op4_html_extraction
from .importance import OP13_SQL, op13_importance_resampling
from .jaccard import OP11_SQL, op11_jaccard_join
from .mixing import op7_mixing
from .neardup import op5_near_dedup
from .packing import op6_packing
from .quality import op2_quality_classifier
from .repeats import op9_suffix_dedup
from .secrets import op1_secret_scans
from .secrets_sql import OP1_SQL
from .topk import OP8_SQL, op8_exact_topk
from .toxicity import op3_toxicity
from .whitening import op12_embedding_whitening

QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_toxicity": op3_toxicity,
    "op4_html_extraction": op4_html_extraction,
    "op5_near_dedup": op5_near_dedup,
    "op6_packing": op6_packing,
    "op7_mixing": op7_mixing,
    "op8_exact_topk": op8_exact_topk,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_audio_features": op10_audio_features,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_importance_resampling": op13_importance_resampling,
}

#: SQL cannot express the others; tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_secret_scans": OP1_SQL,
    "op8_exact_topk": OP8_SQL,
    "op11_jaccard_join": OP11_SQL,
    "op13_importance_resampling": OP13_SQL,
}

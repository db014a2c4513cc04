"""The training-data queries for the driver: name to function of (spark, sf_dir), and SQL where it can express them."""

from __future__ import annotations

from .chat_format import op13_chat_format
from .conversation_repair import op11_conversation_repair
from .exact_search import op7_exact_search
from .fingerprints import op3_fingerprints
from .jaccard_join import op6_jaccard_join
from .mixing import op10_mixing
from .packing import op2_best_fit_packing
from .quality import op9_quality
from .resampling import op12_resampling
from .secret_scan import op5_secret_scan
from .substring_dedup import op1_substring_dedup
from .toxicity import op8_toxicity
from .sql import ORACLES  # noqa: F401  (for the driver)
from .warc import op4_warc

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_warc": op4_warc,
    "op5_secret_scan": op5_secret_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_exact_search": op7_exact_search,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_mixing": op10_mixing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_resampling": op12_resampling,
    "op13_chat_format": op13_chat_format,
}


"""The queries of this subpackage by name, and SQL where it can express one."""

from .alignment import op12_alignment
from .bpe import op4_bpe_encoding
from .decontaminate import ORACLE as DECONTAMINATION_SQL
from .decontaminate import op9_decontamination
from .html_text import op5_html_extraction
from .interpolation import op11_lm_scores
from .neardup import op3_jaccard_join
from .quality import op2_quality_rules
from .repeats import op1_suffix_dedup
from .resampling import ORACLE as RESAMPLING_SQL
from .resampling import op13_resampling
from .secrets import op7_secret_scan
from .token_shards import op10_token_shards
from .toxicity import op6_toxicity
from .url_filter import op8_url_filter

QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_quality_rules, op3_jaccard_join, op4_bpe_encoding, op5_html_extraction, op6_toxicity, op7_secret_scan, op8_url_filter, op9_decontamination, op10_token_shards, op11_lm_scores, op12_alignment, op13_resampling)}
ORACLE_SQL: dict[str, str] = {"op9_decontamination": DECONTAMINATION_SQL, "op13_resampling": RESAMPLING_SQL}

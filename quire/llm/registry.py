"""Queries and SQL of this subpackage, by name."""

from __future__ import annotations

from . import companions
from .centroids import OP11_SQL, op11_centroids
from .chroma import op9_chroma
from .hamming import OP2_SQL, op2_hamming_topk
from .jaccard_join import OP8_SQL, op8_jaccard_join
from .language_id import op10_language_id
from .maintext import op12_main_text
from .ngram_lm import op4_ngram_lm
from .packing import op5_packing
from .pieces import op7_pieces
from .pii import op3_pii
from .quality import op1_quality
from .suffix_dedup import OP6_SQL, op6_suffix_dedup
from .turns import OP13_SQL, op13_turns

QUERIES = {f.__name__: f for f in (op1_quality, op2_hamming_topk, op3_pii, op4_ngram_lm, op5_packing, op6_suffix_dedup, op7_pieces, op8_jaccard_join, op9_chroma, op10_language_id, op11_centroids, op12_main_text, op13_turns)}
QUERIES |= companions.QUERIES
ORACLES: dict[str, str] = {"op2_hamming_topk": OP2_SQL, "op6_suffix_dedup": OP6_SQL, "op8_jaccard_join": OP8_SQL, "op11_centroids": OP11_SQL, "op13_turns": OP13_SQL} | companions.ORACLES

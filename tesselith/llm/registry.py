"""The queries of this subpackage, and SQL for those that SQL can express over whole tables."""

from .bpe import op1_byte_bpe
from .imatch import op5_fingerprints
from .minhash_forest import op9_minhash_forest
from .mixing import op8_mix_sources
from .token_files import op4_token_files
from .nn_descent import op2_nn_descent
from .oracle import ORACLE_SQL
from .phrase_automata import op3_phrase_automata
from .suffix_arrays import op10_suffix_arrays
from .token_counts import op7_token_counts
from .toxicity import op6_toxicity

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_nn_descent": op2_nn_descent,
    "op3_phrase_automata": op3_phrase_automata,
    "op4_token_files": op4_token_files,
    "op5_fingerprints": op5_fingerprints,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_mix_sources": op8_mix_sources,
    "op9_minhash_forest": op9_minhash_forest,
    "op10_suffix_arrays": op10_suffix_arrays,
}

__all__ = ["ORACLE_SQL", "QUERIES"]

"""Registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from .covertree import OP2_SQL, op2_cover_tree
from .decontamination import OP4_SQL, op4_spaced_seeds
from .language import op6_ftrl_language
from .language_model import op8_brown_classes
from .minhash import OP7_SQL, op7_circulant_minhash
from .packing import op5_hilbert_packing
from .pii import op1_offset_deobfuscation
from .sharding import OP10_SQL, op10_prefix_sum_sharding
from .substrings import OP3_SQL, op3_recompression
from .toxicity import op9_multiple_instance_toxicity

QUERIES = {
    "op1_offset_deobfuscation": op1_offset_deobfuscation,
    "op2_cover_tree": op2_cover_tree,
    "op3_recompression": op3_recompression,
    "op4_spaced_seeds": op4_spaced_seeds,
    "op5_hilbert_packing": op5_hilbert_packing,
    "op6_ftrl_language": op6_ftrl_language,
    "op7_circulant_minhash": op7_circulant_minhash,
    "op8_brown_classes": op8_brown_classes,
    "op9_multiple_instance_toxicity": op9_multiple_instance_toxicity,
    "op10_prefix_sum_sharding": op10_prefix_sum_sharding,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {"op2_cover_tree": OP2_SQL, "op3_recompression": OP3_SQL, "op4_spaced_seeds": OP4_SQL, "op7_circulant_minhash": OP7_SQL, "op10_prefix_sum_sharding": OP10_SQL}

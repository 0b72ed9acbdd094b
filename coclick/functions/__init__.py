"""Column expressions (JVM-side, codegen friendly). No Python UDFs here."""

from coclick.functions.ids import item_id_cast, item_id_strict
from coclick.functions.text import array_text, nested_array_text, score_pairs_text
from coclick.functions.vectors import dot, l2_normalize, norm
from coclick.functions.hashing import uniform_hash, floyd_sample

__all__ = [
    "item_id_cast", "item_id_strict", "array_text", "nested_array_text",
    "score_pairs_text", "dot", "l2_normalize", "norm",
    "uniform_hash", "floyd_sample",
]

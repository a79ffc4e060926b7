"""The registered queries of this subpackage and their SQL."""

from . import bpe, clustering, language, licenses, mixing, near_dup, pii, sharding, span_dedup, spelling, topk, toxicity, vector_dup

QUERIES = {f.__name__: f for f in (
    bpe.op1_bpe, sharding.op2_sharding, span_dedup.op3_span_dedup, toxicity.op4_toxicity, pii.op5_pii, licenses.op6_licenses,
    near_dup.op7_near_dup, mixing.op8_mixing, topk.op9_topk, vector_dup.op10_vector_dup,
    spelling.op11_spelling, clustering.op12_clusters, language.op13_language)}

#: Only what SQL can express; the others are tested against brute force.
ORACLE = {"op8_mixing": mixing.ORACLE, "op9_topk": topk.ORACLE, "op12_clusters": clustering.ORACLE}

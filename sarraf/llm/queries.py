"""The queries of the text operators and their answers in SQL."""

from __future__ import annotations

from sarraf.llm import alignment, chat, clusters, mixing, neardup, packing, pages, pii, quality, sharding, suffixes, tokens, vectors

QUERIES = {
    "op1_line_frequency": quality.op1_line_frequency,
    "op2_lsh_forest": neardup.op2_lsh_forest,
    "op3_distinct_words": tokens.op3_distinct_words,
    "op4_columnar_chat": chat.op4_columnar_chat,
    "op5_anchor_expansion": pii.op5_anchor_expansion,
    "op6_two_pass_shuffle": sharding.op6_two_pass_shuffle,
    "op7_suffix_merge": suffixes.op7_suffix_merge,
    "op8_itq_hamming": vectors.op8_itq_hamming,
    "op9_wrapper_induction": pages.op9_wrapper_induction,
    "op10_sainte_lague_mix": mixing.op10_sainte_lague_mix,
    "op11_laesa_clusters": clusters.op11_laesa_clusters,
    "op12_dot_product_packing": packing.op12_dot_product_packing,
    "op13_tokenizer_spans": alignment.op13_tokenizer_spans,
}

ANSWERS = {
    "op1_line_frequency": quality.OP1_SQL,
    "op2_lsh_forest": neardup.OP2_SQL,
    "op4_columnar_chat": chat.OP4_SQL,
    "op8_itq_hamming": vectors.OP8_SQL,
    "op11_laesa_clusters": clusters.OP11_SQL,
}

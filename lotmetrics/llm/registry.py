"""The queries of this subpackage and the SQL of those that SQL can express."""

from . import op1_url_filter, op2_packing, op3_language, op4_chat, op5_pii, op6_simhash, op7_repeats, op8_quality, op9_media, op10_decontaminate, op11_runs, op12_variants, op13_lines

QUERIES = {
    "op1_host_reputation": op1_url_filter.op1_host_reputation,
    "op2_length_buckets": op2_packing.op2_length_buckets,
    "op3_partial_matching": op3_language.op3_partial_matching,
    "op4_grammar_round_trip": op4_chat.op4_grammar_round_trip,
    "op5_anchor_expansion": op5_pii.op5_anchor_expansion,
    "op6_generalised_pigeonhole": op6_simhash.op6_generalised_pigeonhole,
    "op7_sparse_suffix_order": op7_repeats.op7_sparse_suffix_order,
    "op8_compression_classifier": op8_quality.op8_compression_classifier,
    "op9_wav_fingerprints": op9_media.op9_wav_fingerprints,
    "op10_containment": op10_decontaminate.op10_containment,
    "op11_periodic_runs": op11_runs.op11_periodic_runs,
    "op12_spelling_variants": op12_variants.op12_spelling_variants,
    "op13_common_lines": op13_lines.op13_common_lines,
    "host_posteriors": op1_url_filter.host_posteriors,
}
ORACLE = {"op1_host_reputation": op1_url_filter.SQL, "host_posteriors": op1_url_filter.HOSTS_SQL, "op10_containment": op10_decontaminate.SQL, "op13_common_lines": op13_lines.SQL}

"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tallyhouse.llm.chat_format import op3_chat_format
from tallyhouse.llm.collocations import op12_collocations
from tallyhouse.llm.decontamination import op6_decontamination
from tallyhouse.llm.edit_fingerprints import op11_edit_fingerprints
from tallyhouse.llm.jaccard_join import op8_jaccard_join
from tallyhouse.llm.mixing import op2_mixing
from tallyhouse.llm.oracles import COLLOCATIONS, JACCARD
from tallyhouse.llm.packing import op9_token_packing
from tallyhouse.llm.pii import op5_pii_surrogates
from tallyhouse.llm.quality_rules import op10_quality_rules
from tallyhouse.llm.secret_scans import op1_secret_scans
from tallyhouse.llm.spelling import op13_spelling_variants
from tallyhouse.llm.token_counts import op7_token_counts
from tallyhouse.llm.url_filters import op4_url_filters

QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_mixing": op2_mixing,
    "op3_chat_format": op3_chat_format,
    "op4_url_filters": op4_url_filters,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_packing": op9_token_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_edit_fingerprints": op11_edit_fingerprints,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES = {"op8_jaccard_join": JACCARD, "op12_collocations": COLLOCATIONS}

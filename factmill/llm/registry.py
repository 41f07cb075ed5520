"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from factmill.llm.alignment import op11_tokenizer_alignment
from factmill.llm.class_ngrams import op5_class_ngrams
from factmill.llm.decontamination import OP3_SQL, op3_benchmark_decontamination
from factmill.llm.html_extraction import op1_html_host_consensus
from factmill.llm.packing import op7_cutting_stock_packing
from factmill.llm.pii import op6_pii_surrogates
from factmill.llm.sharding import op10_rendezvous_sharding
from factmill.llm.simhash import op8_simhash_neardup
from factmill.llm.spot_signatures import OP12_SQL, op12_spot_fingerprints
from factmill.llm.token_files import op9_separator_token_counts
from factmill.llm.toxicity import op2_toxicity_grammar
from factmill.llm.vector_codes import op13_limb_vector_codes
from factmill.llm.vector_graph import op4_graph_neardup

QUERIES = {
    f.__name__: f
    for f in (
        op1_html_host_consensus,
        op2_toxicity_grammar,
        op3_benchmark_decontamination,
        op4_graph_neardup,
        op5_class_ngrams,
        op6_pii_surrogates,
        op7_cutting_stock_packing,
        op8_simhash_neardup,
        op9_separator_token_counts,
        op10_rendezvous_sharding,
        op11_tokenizer_alignment,
        op12_spot_fingerprints,
        op13_limb_vector_codes,
    )
}
SQL = {"op3_benchmark_decontamination": OP3_SQL, "op12_spot_fingerprints": OP12_SQL}

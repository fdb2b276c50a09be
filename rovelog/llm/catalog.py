"""Every operator of this package as a query over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from rovelog.llm.decontaminate import op8_rare_seed_alignment
from rovelog.llm.hilbert import op3_hilbert_shards
from rovelog.llm.language_id import op9_language_id
from rovelog.llm.line_dedup import op10_fuzzy_lines
from rovelog.llm.merkle import OP12_SQL, op12_merkle_log
from rovelog.llm.minhash import OP6_SQL, op6_chosen_path
from rovelog.llm.packing import op7_pack_powers_of_two
from rovelog.llm.quality import op2_quality_qda
from rovelog.llm.secrets import op5_secret_scan
from rovelog.llm.spotsigs import op11_spot_signatures
from rovelog.llm.subvectors import OP13_SQL, op13_subvector_kmeans
from rovelog.llm.url_filter import op4_url_lm_ratio
from rovelog.llm.vector_graph import OP1_SQL, op1_vector_graph

QUERIES = {
    f.__name__: f
    for f in (
        op1_vector_graph, op2_quality_qda, op3_hilbert_shards, op4_url_lm_ratio, op5_secret_scan, op6_chosen_path, op7_pack_powers_of_two,
        op8_rare_seed_alignment, op9_language_id, op10_fuzzy_lines, op11_spot_signatures,
        op12_merkle_log, op13_subvector_kmeans,
    )
}

ORACLE = {"op1_vector_graph": OP1_SQL, "op6_chosen_path": OP6_SQL, "op12_merkle_log": OP12_SQL, "op13_subvector_kmeans": OP13_SQL}

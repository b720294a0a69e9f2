"""The queries of this subpackage, by name, and DuckDB SQL for those that SQL can express."""

from waymark.llm.chat import op2_chat_windows
from waymark.llm.decontaminate import OP3_SQL, op3_benchmark_decontamination
from waymark.llm.licenses import op6_license_automaton
from waymark.llm.mtree import OP4_SQL, op4_mtree_search
from waymark.llm.neardup import OP10_SQL, op10_superminhash_neardup
from waymark.llm.periodic import OP12_SQL, op12_periodic_runs
from waymark.llm.pieces import op7_piece_sampling
from waymark.llm.polytope import OP11_SQL, op11_polytope_neardup
from waymark.llm.quality import op5_weak_label_quality
from waymark.llm.rtree import OP13_SQL, op13_rtree_negatives
from waymark.llm.sharding import OP9_SQL, op9_stratified_interleave
from waymark.llm.urlfilter import op1_url_markov_ratio
from waymark.llm.warc import OP8_SQL, op8_warc_transactions

QUERIES = {
    "op1_url_markov_ratio": op1_url_markov_ratio,
    "op2_chat_windows": op2_chat_windows,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_mtree_search": op4_mtree_search,
    "op5_weak_label_quality": op5_weak_label_quality,
    "op6_license_automaton": op6_license_automaton,
    "op7_piece_sampling": op7_piece_sampling,
    "op8_warc_transactions": op8_warc_transactions,
    "op9_stratified_interleave": op9_stratified_interleave,
    "op10_superminhash_neardup": op10_superminhash_neardup,
    "op11_polytope_neardup": op11_polytope_neardup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_rtree_negatives": op13_rtree_negatives,
}

ORACLES = {
    "op3_benchmark_decontamination": OP3_SQL,
    "op4_mtree_search": OP4_SQL,
    "op8_warc_transactions": OP8_SQL,
    "op9_stratified_interleave": OP9_SQL,
    "op10_superminhash_neardup": OP10_SQL,
    "op11_polytope_neardup": OP11_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_rtree_negatives": OP13_SQL,
}

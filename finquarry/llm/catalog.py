"""The queries of this subpackage and their check SQL."""

from finquarry.llm.bpe_automaton import op10_bpe
from finquarry.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from finquarry.llm.language_id import OP13_SQL, op13_language_id
from finquarry.llm.lm_scoring import op6_lm_scoring
from finquarry.llm.near_dedup import op2_near_dedup
from finquarry.llm.packing import op4_packing
from finquarry.llm.periodic_runs import op11_periodic_runs
from finquarry.llm.pii import op1_pii
from finquarry.llm.secret_ledger import op5_secret_scan
from finquarry.llm.spelling import OP12_SQL, op12_spelling_variants
from finquarry.llm.token_files import op3_token_files
from finquarry.llm.topk_search import OP7_SQL, op7_topk_search
from finquarry.llm.toxicity import op8_toxicity

OPERATORS = (
    op1_pii, op2_near_dedup, op3_token_files, op4_packing, op5_secret_scan, op6_lm_scoring, op7_topk_search, op8_toxicity, op9_exact_dedup,
    op10_bpe, op11_periodic_runs, op12_spelling_variants, op13_language_id,
)
QUERIES = {f.__name__: f for f in OPERATORS}
SQL = {"op7_topk_search": OP7_SQL, "op9_exact_dedup": OP9_SQL, "op12_spelling_variants": OP12_SQL, "op13_language_id": OP13_SQL}

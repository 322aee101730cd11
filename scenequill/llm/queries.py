"""The registered queries of this subpackage, and the SQL of those that SQL can express on whole tables."""

from .chain_dedup import op8_chain_dedup
from .exact_dedup import OP3_SQL, op3_exact_dedup
from .line_dedup import OP1_SQL, op1_line_dedup
from .mixing import OP6_SQL, op6_mixing
from .packing import op4_packing
from .simhash import op5_simhash_near_dedup
from .suffix_dedup import op2_suffix_dedup
from .suffix_rules import op7_quality_rules
from .token_counts import op10_token_counts
from .token_files import op9_token_files

QUERIES = {
    f.__name__: f
    for f in (op1_line_dedup, op2_suffix_dedup, op3_exact_dedup, op4_packing, op5_simhash_near_dedup, op6_mixing, op7_quality_rules, op8_chain_dedup, op9_token_files, op10_token_counts)
}
ORACLES = {"op1_line_dedup": OP1_SQL, "op3_exact_dedup": OP3_SQL, "op6_mixing": OP6_SQL}

"""The queries of this subpackage, with DuckDB SQL where SQL can express them."""

from .chat_format import op3_chat_windows
from .class_lm import op5_brown_class_lm
from .decontaminate import op1_decontaminate
from .mixing import OP8_SQL, op8_fair_mixing
from .quality import op6_quality_llr
from .sharding import OP4_SQL, op4_extendible_sharding
from .simhash import op9_simhash_bktree
from .substring_dedup import op2_substring_dedup
from .toxicity import op10_toxicity_grammar
from .url_filters import OP7_SQL, op7_redirect_equivalence

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_windows": op3_chat_windows,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_brown_class_lm": op5_brown_class_lm,
    "op6_quality_llr": op6_quality_llr,
    "op7_redirect_equivalence": op7_redirect_equivalence,
    "op8_fair_mixing": op8_fair_mixing,
    "op9_simhash_bktree": op9_simhash_bktree,
    "op10_toxicity_grammar": op10_toxicity_grammar,
}
ORACLE = {
    "op4_extendible_sharding": OP4_SQL,
    "op7_redirect_equivalence": OP7_SQL,
    "op8_fair_mixing": OP8_SQL,
}

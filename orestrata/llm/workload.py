"""The corpus operators as registered queries, and their SQL where SQL can say the same."""
from __future__ import annotations

from orestrata.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from orestrata.llm.fill_in_middle import OP12_SQL, op12_fill_in_middle
from orestrata.llm.fingerprints import op2_imatch
from orestrata.llm.maxent import op13_maxent_score
from orestrata.llm.mixing import OP8_SQL, op8_curriculum_mix
from orestrata.llm.ngram_join import op7_ngram_join
from orestrata.llm.packing import op4_packing
from orestrata.llm.pii import op6_personal_data
from orestrata.llm.quality import op5_quality
from orestrata.llm.sharding import op10_byte_shards
from orestrata.llm.spelling import op11_spelling_variants
from orestrata.llm.token_counts import op9_token_counts
from orestrata.llm.token_files import op3_token_files

QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_imatch,
        op3_token_files,
        op4_packing,
        op5_quality,
        op6_personal_data,
        op7_ngram_join,
        op8_curriculum_mix,
        op9_token_counts,
        op10_byte_shards,
        op11_spelling_variants,
        op12_fill_in_middle,
        op13_maxent_score,
    )
}

ORACLES = {"op1_exact_dedup": OP1_SQL, "op8_curriculum_mix": OP8_SQL, "op12_fill_in_middle": OP12_SQL}

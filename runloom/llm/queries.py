"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from runloom.llm.ann import op5_ann
from runloom.llm.bpe import op9_bpe
from runloom.llm.line_dedup import OP2_SQL, op2_line_dedup
from runloom.llm.packing import op4_packing
from runloom.llm.quality import op8_quality
from runloom.llm.range_join import op6_range_join
from runloom.llm.simhash import op10_simhash
from runloom.llm.suffix_dedup import op1_suffix_dedup
from runloom.llm.token_counts import op7_token_counts
from runloom.llm.toxicity import op3_toxicity

QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_line_dedup, op3_toxicity, op4_packing, op5_ann, op6_range_join, op7_token_counts, op8_quality, op9_bpe, op10_simhash)}

ORACLES: dict[str, str] = {"op2_line_dedup": OP2_SQL}

"""The registered queries of this subpackage and the SQL that some of them can be held against."""

from __future__ import annotations

from warbler.llm.binary import op10_token_files
from warbler.llm.chat import OP7_SQL, op7_chat
from warbler.llm.exact import OP8_SQL, op8_exact_search
from warbler.llm.jaccard import op3_jaccard_join
from warbler.llm.lexical import OP11_SQL, op11_lexical_search
from warbler.llm.mixing import op2_mixing
from warbler.llm.multi_index import op1_multi_index
from warbler.llm.packing import op9_packing
from warbler.llm.perplexity import op12_quality_rules
from warbler.llm.runs import op13_block_runs
from warbler.llm.suffix import op4_suffix_dedup
from warbler.llm.toxicity import op6_toxicity
from warbler.llm.warc import OP5_SQL, op5_warc

QUERIES = {
    "op1_multi_index": op1_multi_index,
    "op2_mixing": op2_mixing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_warc": op5_warc,
    "op6_toxicity": op6_toxicity,
    "op7_chat": op7_chat,
    "op8_exact_search": op8_exact_search,
    "op9_packing": op9_packing,
    "op10_token_files": op10_token_files,
    "op11_lexical_search": op11_lexical_search,
    "op12_quality_rules": op12_quality_rules,
    "op13_block_runs": op13_block_runs,
}

#: DuckDB SQL by query.
ORACLE_SQL: dict[str, str] = {
    "op5_warc": OP5_SQL,
    "op7_chat": OP7_SQL,
    "op8_exact_search": OP8_SQL,
    "op11_lexical_search": OP11_SQL,
}

"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tidewater.llm.chat import op12_token_assembly
from tidewater.llm.decontaminate import op10_winnowing
from tidewater.llm.html_text import op9_line_blocks
from tidewater.llm.importance import op13_importance
from tidewater.llm.langid import op3_rank_order
from tidewater.llm.mixing import op5_entropy_balance
from tidewater.llm.oracles import ORACLES
from tidewater.llm.quality import op7_line_frequency
from tidewater.llm.runs import op11_bit_lags
from tidewater.llm.sharding import op6_hash_tree
from tidewater.llm.simhash import op1_simhash
from tidewater.llm.suffix_tree import op8_suffix_tree
from tidewater.llm.token_store import op2_token_store
from tidewater.llm.tokens import op4_lengths

_ALL = (op1_simhash, op2_token_store, op3_rank_order, op4_lengths, op5_entropy_balance, op6_hash_tree, op7_line_frequency, op8_suffix_tree, op9_line_blocks, op10_winnowing, op11_bit_lags, op12_token_assembly, op13_importance)
QUERIES = {f.__name__: f for f in _ALL}

__all__ = ["ORACLES", "QUERIES"]

"""The registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from clearwell.llm import jaccard, neighbours, sharding
from clearwell.llm.binary import op4_token_ids
from clearwell.llm.jaccard import op2_ngram_jaccard
from clearwell.llm.language import op7_language
from clearwell.llm.mixing import op8_mixing
from clearwell.llm.neighbours import op6_embedding_dedup
from clearwell.llm.packing import op1_best_fit_packing
from clearwell.llm.quality import op9_quality
from clearwell.llm.secrets import op3_secrets
from clearwell.llm.sharding import op10_sharding
from clearwell.llm.toxicity import op5_toxicity

_ALL = (op1_best_fit_packing, op2_ngram_jaccard, op3_secrets, op4_token_ids, op5_toxicity, op6_embedding_dedup, op7_language, op8_mixing, op9_quality, op10_sharding)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE_SQL = {"op2_ngram_jaccard": jaccard.ORACLE_SQL, "op6_embedding_dedup": neighbours.ORACLE_SQL, "op10_sharding": sharding.ORACLE_SQL}

"""The registered queries of this subpackage and the SQL of those that have one."""

from quillspark.llm.ann_mih import op1_multi_index_hashing
from quillspark.llm.fim import OP11_SQL, op11_fill_in_middle
from quillspark.llm.fingerprint import op7_order_min_hash
from quillspark.llm.lexicon import op13_lexicon_bpe
from quillspark.llm.line_dedup import op3_line_chunks
from quillspark.llm.lm_score import op9_pseudo_likelihood
from quillspark.llm.mixing import op10_mix_sources
from quillspark.llm.near_dup import op8_near_duplicates
from quillspark.llm.packing import op4_pack_patterns
from quillspark.llm.quality import op5_quality
from quillspark.llm.secrets import op6_link_secrets
from quillspark.llm.spelling import OP12_SQL, op12_permuterm
from quillspark.llm.wrappers import OP2_SQL, op2_wrapper_text

QUERIES = {f.__name__: f for f in (
    op1_multi_index_hashing, op2_wrapper_text, op3_line_chunks, op4_pack_patterns, op5_quality, op6_link_secrets, op7_order_min_hash, op8_near_duplicates, op9_pseudo_likelihood, op10_mix_sources,
    op11_fill_in_middle, op12_permuterm, op13_lexicon_bpe)}

ORACLES: dict[str, str] = {"op2_wrapper_text": OP2_SQL, "op11_fill_in_middle": OP11_SQL, "op12_permuterm": OP12_SQL}

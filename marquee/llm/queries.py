"""The subpackage's queries and their SQL, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from marquee.llm import (bpe, bpe_index, collocations, decontaminate, jaccard, langid, quality, rules, sarray, spelling, tokens, toxicity, warc)

QUERIES = {
    "op1_warc": warc.q_op1,
    "op2_decontaminate": decontaminate.q_op2,
    "op3_bpe": bpe.q_op3,
    "op4_suffixes": sarray.q_op4,
    "op5_langid": langid.q_op5,
    "op6_quality": quality.q_op6,
    "op7_rules": rules.q_op7,
    "op8_tokens": tokens.q_op8,
    "op9_toxicity": toxicity.q_op9,
    "op10_jaccard": jaccard.q_op10,
    "op11_spelling": spelling.q_op11,
    "op12_bpe": bpe_index.q_op12,
    "op13_collocations": collocations.q_op13,
}

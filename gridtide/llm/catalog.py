"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from gridtide.llm import (
    align,
    codec,
    decontaminate,
    embeddings,
    language,
    pii,
    resample,
    rollup,
    secrets,
    simhash,
    urls,
    wavelet,
    wordwise,
)

QUERIES = {
    "op1_embedding_links": embeddings.op1,
    "op2_secrets": secrets.op2,
    "op3_simhash": simhash.op3,
    "op4_decontaminate": decontaminate.op4,
    "op5_pii": pii.op5,
    "op6_token_rollup": rollup.op6,
    "op7_urls": urls.op7,
    "op8_language": language.op8,
    "op9_bpe": codec.op9,
    "op10_wavelet": wavelet.op10,
    "op11_align": align.op11,
    "op12_wordwise_bpe": wordwise.op12,
    "op13_resample": resample.op13,
}

SQL = {"op6_token_rollup": rollup.OP6_SQL}

"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from logloom.llm import ann, bpe, jaccard, lexical, licenses, mixing, phrases, pii, secret_scan, suffixes, topk, toxicity, warc

QUERIES = {
    "op1_license_scan": licenses.op1,
    "op2_exact_topk": topk.op2,
    "op3_warc": warc.op3,
    "op4_byte_bpe": bpe.op4,
    "op5_pii": pii.op5,
    "op6_jaccard_join": jaccard.op6,
    "op7_ann": ann.op7,
    "op8_secret_scan": secret_scan.op8,
    "op9_toxicity": toxicity.op9,
    "op10_mixing": mixing.op10,
    "op11_lexical_search": lexical.op11,
    "op12_phrase_mining": phrases.op12,
    "op13_suffix_dedup": suffixes.op13,
}

ORACLES = {
    "op1_license_scan": licenses.oracle(),
    "op2_exact_topk": topk.ORACLE,
    "op3_warc": warc.ORACLE,
    "op6_jaccard_join": jaccard.ORACLE,
    "op7_ann": ann.ORACLE,
    "op8_secret_scan": secret_scan.oracle(),
    "op10_mixing": mixing.oracle(),
    "op11_lexical_search": lexical.ORACLE,
    "op12_phrase_mining": phrases.ORACLE,
}

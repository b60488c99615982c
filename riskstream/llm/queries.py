"""Registered queries of the subpackage: name -> builder, and the SQL where it exists."""

from __future__ import annotations

from riskstream.llm import (
    alignment, chat, decontaminate, hpylm, langid, mixing, neardup, pii, prefixtrie, quality,
    sitetemplate, suffixarray, warc)

QUERIES = {
    "op1_hpy_lm": hpylm.op1_hpy_lm,
    "op2_pareto_mixing": mixing.op2_pareto_mixing,
    "op3_minmax_neardup": neardup.op3_minmax_neardup,
    "op4_warc_revisits": warc.op4_warc_revisits,
    "op5_lyndon_suffixes": suffixarray.op5_lyndon_suffixes,
    "op6_snapshot_collapse": chat.op6_snapshot_collapse,
    "op7_wu_manber": decontaminate.op7_wu_manber,
    "op8_crf_langid": langid.op8_crf_langid,
    "op9_host_quality": quality.op9_host_quality,
    "op10_surrogates": pii.op10_surrogates,
    "op11_prefix_trie": prefixtrie.op11_prefix_trie,
    "op12_fragment_alignment": alignment.op12_fragment_alignment,
    "op13_site_templates": sitetemplate.op13_site_templates,
}

ORACLES = {
    "op2_pareto_mixing": mixing.ORACLE,
    "op3_minmax_neardup": neardup.ORACLE,
    "op4_warc_revisits": warc.ORACLE,
    "op6_snapshot_collapse": chat.ORACLE,
    "op7_wu_manber": decontaminate.ORACLE,
    "op9_host_quality": quality.ORACLE,
    "op11_prefix_trie": prefixtrie.ORACLE,
}

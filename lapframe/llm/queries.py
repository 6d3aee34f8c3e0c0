"""Named queries of the operators, and SQL that says the same where SQL can."""

from __future__ import annotations

from lapframe.llm import (
    chat_format,
    collocations,
    decontaminate,
    html_text,
    line_dedup,
    neighbours,
    packing,
    prefix_free,
    ranked_search,
    secrets,
    simhash,
    substring_dedup,
    toxicity,
)
from lapframe.llm.ship import shipped

QUERIES = {
    "op1_substring_dedup": shipped(substring_dedup.query),
    "op2_html_text": shipped(html_text.query),
    "op3_simhash": shipped(simhash.query),
    "op4_secrets": secrets.query,
    "op5_neighbours": shipped(neighbours.query),
    "op6_packing": shipped(packing.query),
    "op7_line_dedup": shipped(line_dedup.query),
    "op8_toxicity": shipped(toxicity.query),
    "op9_chat_format": shipped(chat_format.query),
    "op10_decontaminate": shipped(decontaminate.query),
    "op11_ranked_search": shipped(ranked_search.query),
    "op12_prefix_free": shipped(prefix_free.query),
    "op13_collocations": shipped(collocations.query),
}

ORACLES = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op4_secrets": secrets.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op12_prefix_free": prefix_free.ORACLE,
    "op13_collocations": collocations.ORACLE,
}

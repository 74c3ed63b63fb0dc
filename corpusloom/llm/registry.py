"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from corpusloom.llm import chat, decontamination, search
from corpusloom.llm.chat import op5_chat
from corpusloom.llm.decontamination import op7_decontamination
from corpusloom.llm.langid import op1_language_id
from corpusloom.llm.linkgraph import op8_url_filter
from corpusloom.llm.neardup import op6_near_duplicates
from corpusloom.llm.packing import op2_packing
from corpusloom.llm.pii import op9_pii
from corpusloom.llm.quality import op3_quality
from corpusloom.llm.runs import op11_periodic_runs
from corpusloom.llm.search import op12_ranked_search
from corpusloom.llm.secretscan import op13_secret_scan
from corpusloom.llm.toxicity import op10_toxicity
from corpusloom.llm.transport import op4_media

_OPERATORS = (
    op1_language_id, op2_packing, op3_quality, op4_media, op5_chat,
    op6_near_duplicates, op7_decontamination, op8_url_filter, op9_pii, op10_toxicity,
    op11_periodic_runs, op12_ranked_search, op13_secret_scan,
)
QUERIES = {f.__name__: f for f in _OPERATORS}
ORACLES: dict[str, str] = {"op5_chat": chat.ORACLE, "op7_decontamination": decontamination.ORACLE, "op12_ranked_search": search.ORACLE}

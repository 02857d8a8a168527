"""Registered queries of the dealt operators and, where SQL can express one,
its DuckDB text."""

from __future__ import annotations

from pixelframe.llm.alignment import op12_alignment
from pixelframe.llm.decontaminate import ORACLE as OP8_SQL, op8_decontaminate
from pixelframe.llm.html_text import op3_html
from pixelframe.llm.lines import ORACLE as OP6_SQL, op6_lines
from pixelframe.llm.lm import op5_lm
from pixelframe.llm.mixing import op1_mixing
from pixelframe.llm.packing import op11_packing
from pixelframe.llm.passages import op7_passages
from pixelframe.llm.quality import op4_quality
from pixelframe.llm.rules import op9_rules
from pixelframe.llm.simhash import op10_simhash
from pixelframe.llm.urls import op2_urls
from pixelframe.llm.whitening import op13_whitening

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_urls": op2_urls,
    "op3_html": op3_html,
    "op4_quality": op4_quality,
    "op5_lm": op5_lm,
    "op6_lines": op6_lines,
    "op7_passages": op7_passages,
    "op8_decontaminate": op8_decontaminate,
    "op9_rules": op9_rules,
    "op10_simhash": op10_simhash,
    "op11_packing": op11_packing,
    "op12_alignment": op12_alignment,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op6_lines": OP6_SQL,
    "op8_decontaminate": OP8_SQL,
}

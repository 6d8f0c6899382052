"""All queries of this subpackage; importing it registers them."""

from __future__ import annotations

from fitlens.llm import bpe, conversation_repair, decontaminate, html_text, licenses, line_dedup, near_duplicates, nearest, periodic_runs, pii, quality, secrets, url_rules  # noqa: F401
from fitlens.llm.registry import ORACLES, QUERIES  # noqa: F401

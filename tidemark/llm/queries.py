"""All queries of this subpackage; importing it registers them."""

from tidemark.llm import decontamination, filter_audit, html_text, near_copies, personal_data, piece_encoding, pivot_search, quality, repeated_text, suffix_tree, token_counts, toxicity, vector_codes  # noqa: F401
from tidemark.llm.common import ORACLES, QUERIES  # noqa: F401

"""The registered queries of this subpackage and their SQL."""

from lakeloom.llm import chat, decontamination, exact_dedup, extraction, hard_negatives, language_model, licenses, mixing, ngram_join, part_codes, quality, simhash, token_counts  # noqa: F401
from lakeloom.llm.common import ORACLE, QUERIES  # noqa: F401

"""Importing this module registers every query of the subpackage."""

from callsift.llm import (  # noqa: F401
    bpe,
    centroid_clustering,
    chat_formatting,
    embedding_dedup,
    exact_dedup,
    html_extraction,
    line_dedup,
    ngram_join,
    packing,
    quality,
    suffix_dedup,
    toxicity,
    vector_codes,
)

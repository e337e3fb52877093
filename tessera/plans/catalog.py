"""Importing this module registers every query of the library."""

from tessera.plans import (  # noqa: F401
    corpus_documents,
    corpus_flows,
    corpus_gold,
    corpus_ml,
    corpus_relational,
    corpus_silver,
    corpus_sources,
    corpus_units,
    corpus_windows,
)

"""Training-data operators: scoring, de-duplication, filtering, extraction, tokens.

Nothing else in the library imports this subpackage; it may use general helpers
(:mod:`shoplens.session`) but not the other way round.
"""

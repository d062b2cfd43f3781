"""Operators of a training-data pipeline (deduplication, language, licences, packing, language models, archives).

Nothing else in the package imports this subpackage.
"""

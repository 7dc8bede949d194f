"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries.py`` derives the registered
``opN_*`` queries from them, and ``corpus_pipeline.py`` at the repository top
chains five of them.
"""

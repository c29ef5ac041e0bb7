"""Operators for preparing language-model training data.

Ten operators over ``documents``, ``pages``, ``benchmark`` and ``labels``; each
module holds one operator with its own interface, ``registry`` holds the
contract queries (``opN_<name>``), and ``corpus_pipeline.py`` chains five of
them.  Nothing outside this package imports it.
"""

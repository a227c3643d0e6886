"""Operators for preparing training corpora: ten operators over `documents` and `embeddings`.

Nothing outside this package imports it.
"""

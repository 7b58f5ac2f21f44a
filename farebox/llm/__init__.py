"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Nothing outside this subpackage imports it; general helpers (session, scratch
folders) come from the rest of the library.
"""

"""Operators for preparing text corpora for language-model training.

Nothing outside this subpackage imports it; its queries and oracle SQL are in
``garimpo.llm.queries``.
"""

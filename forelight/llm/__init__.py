"""Operators for preparing large text corpora.

Nothing outside this subpackage imports it; ``forelight.llm.registry`` lists
its queries and the SQL they are checked against.
"""

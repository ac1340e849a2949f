"""Training-data pipeline operators (deduplication, scoring, mixing, encoding).

Nothing outside this folder imports it; ``kiln.llm.queries`` registers the
``opN_<name>`` queries.
"""

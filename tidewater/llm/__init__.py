"""Training-data pipeline operators (exact and near de-duplication, mixing, packing, ...).

Nothing outside this package imports it; its queries are in ``tidewater.llm.queries``.
"""

"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; ``queries()`` and ``oracle_sql()``
are what the entry module adds when the subpackage is present.
"""


def queries():
    """All queries of the subpackage: ``op1_...`` to ``op10_...`` and ``pipeline``."""
    import corpus_pipeline

    from tidemark.llm import registry

    return {**registry.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql():
    """DuckDB SQL of the queries that SQL can express."""
    import corpus_pipeline

    from tidemark.llm import registry

    extra = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**registry.ORACLE_SQL, **extra}

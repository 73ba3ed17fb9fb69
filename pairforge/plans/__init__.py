"""Registered driver queries: each is a Spark callable ``(spark, sf_dir) ->
DataFrame`` plus (where SQL can express it) the equivalent DuckDB SQL over
the same tables, used as an independent oracle."""

from pairforge.plans.registry import ORACLE, QUERIES  # noqa: F401
from pairforge.plans import (  # noqa: F401  (imports register the queries)
    pairing,
    text,
    splitting,
    evaluation,
    candidates,
    featurize,
    vocab,
    extraction,
    ops,
    models,
    store,
    files,
    corpus,
)

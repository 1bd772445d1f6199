"""Operations of a training-data pipeline, one module per operator.

Nothing else in ``corvid`` imports this package. ``queries.py`` registers one
query ``opN_<name>`` per operator and ``pipeline``; ``__spark_entry__`` adds
them when the package is there.
"""

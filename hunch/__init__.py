"""hunch — known-item retrieval on Spark DataFrames.

Subpackages: ``sources`` (tables, corpus files, topics, judgements, sinks),
``functions`` (Column expressions), ``operators`` (index, ranking, fusion,
annotation, decomposition, presentation, evaluation), ``plans`` (end-to-end flows and
the named query catalogue) and ``streaming`` (the query stream).
"""

__version__ = "0.1.0"

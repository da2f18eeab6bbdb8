"""mercato: a Spark-native commerce warehouse and micro-batch analytics library.

Layers: ``sources`` (readers, fixture views, sinks) -> ``plans.staging``
(cleaners) -> ``plans.warehouse`` (dimensions, facts) -> ``plans.aggregates``
(summaries) -> ``plans.reads`` (serving queries); ``plans.microbatch`` and
``plans.rollups`` for the 5-minute event-time batches; ``streaming`` for the
Structured Streaming form; ``operators`` and ``functions`` hold the reusable
DataFrame and Column building blocks.
"""

__version__ = "0.1.0"

"""Card transaction monitoring on Spark.

Layers (each a ``DataFrame -> DataFrame`` function, batch or stream):
``operators.bronze``, ``operators.silver`` (expectations in
``operators.quality``), ``operators.gold`` (alerts, windowed counts),
``operators.alerts`` (messages, digests, outbox), ``operators.feed``
(watchlist delivery).  Running them: ``streaming.pipeline`` (tables,
checkpoints, availableNow or continuous) and ``streaming.job`` (command
line).  Sources: ``sources.kafka``, ``sources.files``, ``sources.jdbc``.
"""

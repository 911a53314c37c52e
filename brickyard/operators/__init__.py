"""DataFrame -> DataFrame operators.

Most operators only build a lazy plan. The exceptions are deliberate and
small:
- size checks that license a broadcast: ``star.broadcast_if_small``, and the
  query-block sizing in ``retrieve``, which also collects each bounded
  block's query side to broadcast it;
- ``load.assert_unique`` (the ``validate=`` guard);
- the sink ``load.merge_partitions``;
- ``quality.enforce``, which collects the one-row-per-check report.
"""

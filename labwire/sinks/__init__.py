"""Sinks: table upsert (K1 on files), JDBC upsert (K1/K3/K6), dead letters (K4)
and the two-sink fan-out used by ``foreachBatch`` (K5)."""

"""DataFrame -> DataFrame operators: as-of joins and per-user windows, enrichment,
event alignment, features, dataset split, scoring, metrics, training,
explanations, analytics, and the distributed statistics helpers they share."""

"""Streaming: intentionally empty.

The source system retrains nightly from batch tables; it has no streams,
watermarks, windows over event time or late-data handling.  Every operator in
this package is a batch DataFrame function, which Structured Streaming can
also run inside ``foreachBatch`` if a caller wants micro-batch refreshes.
"""

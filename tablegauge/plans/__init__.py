"""End-to-end flows composed from operators (training run, sweep, drift
monitoring) and the query catalogue used by ``__spark_entry__``."""

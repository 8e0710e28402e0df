"""Time-series synchronisation and spatial transforms as Spark DataFrame jobs."""

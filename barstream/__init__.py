"""Price/volume bar and tick-stream analytics expressed as Spark jobs."""

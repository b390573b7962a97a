"""Environmental time-series preparation and analysis as Spark DataFrame jobs."""

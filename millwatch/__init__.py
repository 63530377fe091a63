"""millwatch: sensor-failure analytics expressed as Spark DataFrame jobs."""

"""Entity-by-period panel analytics as Spark DataFrame jobs."""

"""fillwatch: Spark jobs over a fleet of container sensors."""

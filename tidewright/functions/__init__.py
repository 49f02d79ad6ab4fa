"""Column functions composed from Spark built-ins."""

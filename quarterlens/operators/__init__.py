"""DataFrame -> DataFrame operators built from Spark built-ins."""

"""wardstat: civic service analytics as DataFrame -> DataFrame operators on Spark."""

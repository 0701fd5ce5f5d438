"""Stream and batch analytics operators written on the Spark DataFrame API."""

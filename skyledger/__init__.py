"""Daily climate records and yearly trends as Spark DataFrame operators."""

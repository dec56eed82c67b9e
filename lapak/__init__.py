"""lapak: retail sales analytics as plain Spark DataFrame transformations."""

"""Academic-records lakehouse analytics written as plain Spark DataFrame jobs."""

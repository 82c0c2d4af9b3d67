"""Panel, event and corpus operators written as plain Spark DataFrame programs."""

"""SQL that says, independently of the Spark code, what every query must return."""

"""Commerce and engagement analytics as composable Spark DataFrame operators."""

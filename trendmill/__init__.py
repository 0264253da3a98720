"""Signal analytics as composable Spark DataFrame functions."""

"""Composable Spark DataFrame operators for curating training data and analysing geospatial evidence."""

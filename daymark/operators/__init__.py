"""Composable ``DataFrame -> DataFrame`` operators."""

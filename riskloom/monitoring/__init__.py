"""Data quality, drift, evaluation and audit."""

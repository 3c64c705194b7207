"""Scorers: rules, isolation forest, reconstruction error, ensemble."""

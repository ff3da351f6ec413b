"""Data model, report catalogue and the registered queries."""

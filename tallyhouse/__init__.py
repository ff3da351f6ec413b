"""Retail warehouse jobs written as Spark DataFrame functions."""

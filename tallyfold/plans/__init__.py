"""Whole tables and reports put together from the operators."""

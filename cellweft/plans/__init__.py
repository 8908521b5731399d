"""Whole dataflows put together from the operators."""

"""Whole loads and reads put together from the operators."""

"""Cleaning, joining and reporting put together from the operators."""

"""Scalar building blocks."""

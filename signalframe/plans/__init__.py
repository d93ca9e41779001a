"""Reusable plan shapes: staging, ordered work in bounded blocks, exact quantiles."""

"""Whole-population DataFrame transforms over the fact model."""

"""Whole jobs: training with logging, and scoring."""

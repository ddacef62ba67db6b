"""Composed jobs: feature build, training, scoring, explanation."""

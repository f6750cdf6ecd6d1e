"""Composite jobs: preprocessing, dimensions, fact, quality reports, the whole star."""

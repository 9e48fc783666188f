"""Whole jobs: the stored tables and the runs that fill them."""

"""Whole jobs: campaign load, insight load, extraction planning, gold refresh."""

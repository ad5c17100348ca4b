"""Layered (raw -> silver -> gold) tables with late corrections, as Spark jobs."""

"""DataFrame operators: normalising, guarding, merging, planning of due work."""

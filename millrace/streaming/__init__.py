"""Run-to-run processing: what changed since the previous run.

The reports are periodic batches that carry state in tables, so this package
compares runs instead of keeping a stream open.
"""

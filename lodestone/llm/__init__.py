"""Operators of a training-data pipeline: scans, dedup, joins, archives, quality, mixing.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries when it is there.
"""

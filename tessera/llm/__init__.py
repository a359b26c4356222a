"""Operators for training-data pipelines (quality, dedup, decontamination, tokens, ...).

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when present.
"""

"""Operators for large-scale training-data work (deduplication, extraction,
decontamination, mixing, sharding, secrets, language identification).

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""

"""Operators for preparing training text (deduplication, decontamination,
quality, token counts, secrets, toxicity, language, mixing).

Nothing else in ``grainline`` imports this subpackage; ``queries`` registers
its operators for ``__spark_entry__``.
"""

"""Localization data engine on Spark: dumps, memories, audits and gates as DataFrame operators."""

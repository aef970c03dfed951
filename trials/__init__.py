"""Trial queries: every operator run over the given tables.

The tables hold no receiver lines, so ``encode`` derives them in Spark, one
line per row, and ``catalog`` runs the engine over those lines.  ``expected``
states each result in SQL over the source columns, without decoding anything.
"""

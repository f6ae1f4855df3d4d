"""Training-data operators: ten self-contained components over document tables.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when the package is present.
"""

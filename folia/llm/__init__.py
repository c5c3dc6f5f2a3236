"""Training-data operators: corpus operators and their registered queries.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when it can be imported. Each operator module has a general function and
a thin ``opN_<name>`` query over the driver's tables.
"""

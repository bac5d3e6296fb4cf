"""Task-dataset preparation as Spark plans.

Nothing in this package, apart from the entry module that registers
queries, imports :mod:`taskmill.llm`; that subpackage may be removed.
"""

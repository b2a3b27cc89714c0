"""Operations of a training-data pipeline on whole document and vector tables.

Nothing else in the library imports this package. Every operator takes
DataFrames and column names, has its own general interface, and is registered
as one query in ``ferry.llm.queries``.
"""

"""DuckDB statements that state each registered query a second time.

They share no code with the Spark package: the prelude below and every
statement were written from the specification alone.
"""

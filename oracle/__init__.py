"""DuckDB statements that say the same as the registered queries.

``SQL`` maps query names to statements over the test tables. Money is summed
as DECIMAL(18,2) and returned as DOUBLE; means are rounded half up from whole
cents, because DuckDB divides decimals as doubles.
"""

from oracle import analyses, checks, lake_tables, loads

SQL: dict[str, str] = {**lake_tables.SQL, **loads.SQL, **checks.SQL, **analyses.SQL}

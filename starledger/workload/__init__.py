"""The registered queries: test tables in the roles of raw records, and an SQL statement for each query."""

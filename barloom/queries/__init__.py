"""The registered queries, each over whole given tables, and the SQL each one is checked against."""

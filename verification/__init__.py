"""Stand-in entities made of the test tables, the registered queries, and their SQL twins."""

"""Tables with versions, search over vectors and text, and the queries that use them, as Spark DataFrames."""

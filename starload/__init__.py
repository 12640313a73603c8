"""starload: declarative star-schema loads and reconciliation on Spark DataFrames."""

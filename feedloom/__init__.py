"""feedloom: vendor feeds to trustworthy tables, as PySpark DataFrame operators."""

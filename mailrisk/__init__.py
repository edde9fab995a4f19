"""E-mail risk analytics on PySpark: every operator is a DataFrame function."""

"""Retail analytics on Spark: contracts, a bronze/silver/gold lake, marts and sheet cleaning."""

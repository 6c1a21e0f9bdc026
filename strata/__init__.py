"""strata: layered (bronze, silver, gold) analytics as plain PySpark DataFrame operators."""

"""Medallion warehouse operators on PySpark: merges, SCD2, as-of reads, cleaning, marts."""

"""strandmart: clinical-genomics operations warehouse as PySpark DataFrame jobs."""

__version__ = "0.1.0"

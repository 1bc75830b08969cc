"""The nine marketplace tables: from the driver's tables or from CSV files."""

"""Retail sales, tender, inventory and customer measures as Spark DataFrame jobs."""

"""The same measures as plain SQL, written apart from the Spark code, for comparison."""

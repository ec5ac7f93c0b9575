"""Loan recommendations on Spark: cleaning, encoding, factorisation, ranking and reporting as DataFrame jobs."""

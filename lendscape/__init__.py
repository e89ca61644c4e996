"""Loan-portfolio risk analytics as Spark DataFrame operators."""

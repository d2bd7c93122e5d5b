"""Ingestion and data-quality operators for customer, transaction and KYC records on Spark."""

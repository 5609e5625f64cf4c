"""sieveline: cleaning, validating and packing of web text corpora on Spark."""

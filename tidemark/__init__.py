"""User labelling over change feeds, page logs and orders, written for Spark."""

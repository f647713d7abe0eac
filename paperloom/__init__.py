"""Spark jobs over corpora of marked-up scholarly documents."""

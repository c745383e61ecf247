"""Lodestone: document analytics and retrieval as declarative Spark plans."""

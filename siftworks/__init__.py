"""Siftworks: a PySpark engine that turns raw domain lists and web pages into classified lead records."""

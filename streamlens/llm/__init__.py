"""Operators of a training-data pipeline.  Nothing else in streamlens imports this."""

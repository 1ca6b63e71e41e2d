"""Spark ML: surge-multiplier regression (train, evaluate, save, score)."""

"""Composed pipelines (masters, features, folds, models, diagnostics) and the
driver-facing query catalog."""

"""Operators: window features, lookups, models, tree SHAP, drift, run log."""

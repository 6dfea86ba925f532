"""Panel, recurrence, residual, bootstrap, catalogue and graph operators."""

"""Part of gridsight."""

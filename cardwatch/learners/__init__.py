"""Classifiers: presets of the built-in learners and the ones composed here."""

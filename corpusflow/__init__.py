"""Corpusflow: a PySpark-native engine for building and analysing speech-and-text corpora."""

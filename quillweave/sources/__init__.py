"""Readers of article records, annotated corpora and vocabularies."""

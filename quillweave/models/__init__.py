"""A tagger and a pair classifier that are trained here, and what both share."""

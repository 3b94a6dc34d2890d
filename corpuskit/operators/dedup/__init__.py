"""Removal of duplicates: methods that find pairs or clusters, and what they share."""

"""Parcel-logistics warehouse on Spark: change feeds -> dimensions, facts, daily marts."""

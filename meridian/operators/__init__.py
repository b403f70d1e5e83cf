"""Relational, spatial, temporal, vector and graph operators over DataFrames."""

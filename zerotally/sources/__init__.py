"""Reading, writing and naming tables."""

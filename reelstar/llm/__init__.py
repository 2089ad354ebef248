"""Training-data operators: formatting, filtering, scoring, search, packing."""

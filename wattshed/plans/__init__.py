"""Named datasets and answers: each is a function from input DataFrames to one DataFrame."""

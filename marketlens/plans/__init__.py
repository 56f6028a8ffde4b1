"""Model graph: each model is a function of DataFrames; Catalyst plans the composition."""

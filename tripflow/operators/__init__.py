"""The batch layers, each a function from DataFrame to DataFrame."""

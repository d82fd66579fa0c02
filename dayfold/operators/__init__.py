"""Steps from DataFrame to DataFrame."""

"""Input tables and output writers."""

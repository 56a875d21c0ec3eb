"""Complete jobs a user calls."""

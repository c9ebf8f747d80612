"""The registered queries."""

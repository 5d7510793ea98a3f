"""The registered queries and their equivalents in plain SQL."""

"""Query API and the end-to-end batch run."""

"""Layer builders, the end-to-end refresh, and the reports."""

"""Plans: dashboard queries over marts and the end-to-end pipeline."""

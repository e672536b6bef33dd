"""Named views, analyses, checks and exports."""

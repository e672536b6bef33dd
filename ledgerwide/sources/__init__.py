"""Reading landings and writing staging, fact and CSV outputs."""

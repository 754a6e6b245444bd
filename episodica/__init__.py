"""Active-search worklists on Spark: who is in an open care episode, and what is still missing."""

"""Building blocks: rating, dimensions, fact table, star join, pivot, ratio and top-k."""

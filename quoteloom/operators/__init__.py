"""DataFrame in, DataFrame out. Nothing here writes, collects or depends on the current date."""

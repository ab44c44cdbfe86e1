"""Document retrieval on Spark: pages, chunks, vectors, collections, nearest-neighbour search."""

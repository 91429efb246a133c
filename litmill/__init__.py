"""litmill: Spark jobs for building trustworthy literature and document corpora."""

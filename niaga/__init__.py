"""niaga: a retail data mart built and queried as Spark jobs."""

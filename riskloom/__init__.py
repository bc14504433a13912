"""riskloom: credit-risk features, scoring and monitoring as Spark jobs."""

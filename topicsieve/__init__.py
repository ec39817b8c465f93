"""Document relevance against an editable topic, as Spark jobs."""

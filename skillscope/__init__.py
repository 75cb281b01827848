"""Pay and skill analytics over postings and survey tables, as Spark DataFrame operators."""

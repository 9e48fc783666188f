"""Clinical record processing as Spark jobs: validate, clean, enrich, nest, merge, serve."""

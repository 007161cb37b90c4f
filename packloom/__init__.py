"""packloom: build, query and validate retrieval packs on Spark."""

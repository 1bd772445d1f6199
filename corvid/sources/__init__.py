from corvid.sources.tables import load_table, load_labelled, split_counts  # noqa: F401

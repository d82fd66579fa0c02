"""Operations of a training-data pipeline: deduplication, mixing, fingerprints, filters and classifiers."""

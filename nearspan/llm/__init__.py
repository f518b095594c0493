"""Operations of a training-data pipeline: cleaning, deduplication, scoring, mixing and sharding."""

"""Operations of a training-data pipeline, apart from the rest of the library."""

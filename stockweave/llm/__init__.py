"""Operations of a training-data pipeline: extraction, cleaning, scoring, search and mixing."""

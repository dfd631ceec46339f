"""Operations of a training-data pipeline: scoring, cleaning, joining, mixing and packing texts."""

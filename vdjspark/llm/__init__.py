"""Operations of a training-data pipeline at corpus scale."""

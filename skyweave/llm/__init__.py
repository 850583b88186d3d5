"""Operations on text corpora for training data."""

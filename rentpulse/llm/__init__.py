"""Operations on training data for language models."""

"""Operations for building training corpora: deduplication, filtering, scoring, packing, archiving."""

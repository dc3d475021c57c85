"""Operators for training corpora: deduplication, sharding, quality, decontamination, token counts, packing, chat."""

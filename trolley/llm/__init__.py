"""Operators of a training-data pipeline: quality, dedup, decontamination,
archives, token files, extraction and mixing.  Nothing outside imports this."""

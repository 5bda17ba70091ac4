"""Operators of a training-data pipeline (decontamination, language ID, mixing,
near-dedup, sharding, quality, token files, nearest neighbours, URL rules and
repeated passages).  Nothing outside this subpackage imports it."""

"""Operators of a training-data pipeline: de-duplication, quality, language,
formatting, tokenisation and packing.  Nothing else in the library imports
this subpackage; its registered queries live in ``queries``."""

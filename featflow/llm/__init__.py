"""Training-data operators for large text corpora (language id, tokenization,
secret scans, decontamination, deduplication, chat formatting, quality rules,
token counts and binary token files).  Nothing else in the library imports
this subpackage."""

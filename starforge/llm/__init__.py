"""Operators for preparing large text corpora (fingerprints, de-duplication,
sharding, packing, filters, language models).  Nothing outside this
subpackage imports it; its queries are in ``starforge.llm.queries``."""

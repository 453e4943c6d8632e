"""Operators for preparing large text corpora: filtering, near-duplicate removal,
tokenising, packing, sharding.  Nothing outside this subpackage imports it."""

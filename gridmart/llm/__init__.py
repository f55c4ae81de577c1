"""Training-data operators: URL lists, language, quality, duplicates, sharding,
mixing, toxicity and tokenisation, each written as Spark jobs over whole tables.

Every module holds one operator with its own general interface; ``queries``
binds the operators to the driver tables.  Nothing outside this subpackage
imports it.
"""

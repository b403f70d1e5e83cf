"""Training-data operators: search, dedup, classifiers, media, tokens, licences, mixing, sharding.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""

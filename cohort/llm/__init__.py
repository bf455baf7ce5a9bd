"""Training-data operators: tokens, near-duplicates, contamination, models, search, secrets, PII.

Nothing outside this subpackage imports it. ``catalog.QUERIES`` binds each
operator to its table; the operators themselves take any DataFrame with the
named columns and look at no others, so extra or clashing columns are harmless.
"""

"""DataFrame operators for exploring and mining large review-like tables.

``sources``    readers and writers
``functions``  column expressions (tokens, categories, years, hashes)
``operators``  DataFrame building blocks (counts, layout, itemsets, set similarity)
``plans``      whole reports, the query catalogue and its SQL oracle
"""

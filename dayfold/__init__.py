"""Daily per-country documents to star schema, and the questions asked of it.

Layout:

* ``sources``    raw documents, codebook, parameter tables, warehouse tables
* ``functions``  column expressions (dates, text, numbers, variant access)
* ``operators``  DataFrame-to-DataFrame steps (outcome, upsert, checks, ranks)
* ``plans``      star schema, dashboard questions, the batch jobs
* ``streaming``  incremental pick-up of raw documents
"""

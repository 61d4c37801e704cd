"""Training-data operators (numbered 1 to 10) and their queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which is counted
as part of it) imports it; ``__spark_entry__`` adds the queries only when the
subpackage can be imported.
"""

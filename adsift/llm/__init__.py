"""Operators for preparing large training corpora.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is present. Each operator takes a DataFrame and column names,
reads only the columns it needs, and keeps everything that grows with the
corpus on the executors or in tables under ``spark.checkpoint.dir``.
"""

"""Training-data operators: quality, deduplication, decontamination, privacy,
tokenisation and chat formatting over ``documents``-like tables.

Nothing outside this subpackage imports it.
"""

from pyspark import cloudpickle

# Task code travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["llm"]))

"""tunesmith: the data side of language-model fine-tuning as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns). Nothing here
trains or serves a model; see README.md for what is and is not built.
"""

__version__ = "0.1.0"

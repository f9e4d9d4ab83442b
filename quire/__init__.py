"""quire: instruction-data curation and text-generation evaluation on Spark.

Every public operator takes and returns DataFrames (or Columns); the heavy work
is planned by Catalyst. Python runs inside tasks only for the LCS/stemming kernel
of ROUGE-L, user generators and user tokenizers.
"""

from quire.session import checkpoint_root, get_spark, stage

__all__ = ["get_spark", "checkpoint_root", "stage"]

"""posgraph: retail point-of-sale detail as a purchase graph, on Spark DataFrames.

Stage 1 reshapes POS lines into node sets (person, product, store) and edge
sets (purchase, visit).  Stage 2 flattens them into five graph tables with
defaults, integrity joins and upserts.  Stage 3 answers lookups and
recommendation queries on those tables.  Every function takes and returns
lazy DataFrames; nothing is collected inside an operator.
"""

from posgraph.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]

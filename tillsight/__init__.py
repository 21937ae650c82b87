"""tillsight: retail-analytics operators written as Spark DataFrame plans.

Every operator is a plain function ``DataFrame(s) + parameters -> DataFrame``.
Work is expressed with built-in Spark SQL expressions so that Catalyst can
prune, push down and codegen it; the one exception is the tiled co-occurrence
product of the item recommender, which runs numpy inside ``applyInPandas``
groups that Spark partitions and shuffles.
"""

__version__ = "0.1.0"

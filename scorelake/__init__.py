"""Assessment-score analytics on Spark: DataFrame in, DataFrame out.

No module here creates a session; every function works on the frames it is
given, and only ``sources`` and ``plans.layers`` write anything.
"""

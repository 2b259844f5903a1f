"""tillcast — retail demand analytics on Spark.

Every public operator is a plain ``DataFrame -> DataFrame`` function (plus
parameters).  Nothing in the library calls ``collect()`` on data-sized
results; the few driver round-trips that exist return a scalar or a schema.
"""

__version__ = "0.1.0"
